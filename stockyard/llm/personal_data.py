"""Personal data by weak supervision.

Patterns propose spans. Labelers vote on each of them: the strict form, a gazetteer, the words before
it, its edges and its shape. Nothing is labelled by hand: expectation-maximisation finds from the votes'
agreement how reliable each labeler is and how likely each span is personal data, and these
probabilities train the final classifier, a logistic regression over votes, kind and length.
Spans of the base rules always stay; the classifier adds spans of the other kinds.

Texts are worked on by SQL functions alone. What is trained rests on counts of equal votes over all
documents, a table of a bounded size (kinds x votes x lengths).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import stored

# The base kinds, in their order, as patterns that never look at a character twice.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Kinds the method adds: secrets, card numbers inside longer rows of digits, telephone numbers without
# a country, personal numbers.
OTHER = {
    "secret": r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])(?=[0-9_/+-]*+[A-Za-z])[A-Za-z0-9_/+-]{16,}+",
    "number": r"(?<![0-9A-Za-z.+-])[0-9]{13,19}(?![0-9A-Za-z])",
    "tel": r"(?<![0-9A-Za-z+().-])(?<!\+[0-9]{1,3}[ -])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
}
KINDS = BASE | OTHER
# What each labeler goes by.
BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
STRICT = {
    "secret": r"^(?:AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36}|[0-9a-f]{16,64}|[A-Za-z0-9/+]{40})$",
    "tel": r"^\(?[2-9][0-9]{2}\)?[ .-][2-9][0-9]{2}[ .-][0-9]{4}$",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
}
GAZETTEER = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|info|io|co|de|fr|es|uk|eu)$",
    "ip": r"^(?!0\.|127\.|255\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "number": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^\+(?:1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "secret": r"^(?:AKIA|ASIA|ghp_|gho_|xox[bp]-|sk_live_|AIza)",
    "tel": r"^\(?(?:20[1-9]|21[0-9]|30[1-9]|31[0-9]|40[1-9]|41[0-9]|51[0-9]|61[0-9]|71[0-9]|80[1-8])",
}
BEFORE_PERSONAL = (
    r"(?i)(?:pass(?:word|wd)?|token|secret|api.?key|access.?key|e?-?mail|tel|phone|call|fax|mobile|card|visa|ssn|social)"
    r"[\s:=\"'.#]*$"
)
BEFORE_OTHER = r"(?i)(?:version|release|licen[cs]e|isbn|issn|doi|page|figure|section|commit|sha1|md5|v)[\s:=.]*$"

VOTES = ("strict", "listed", "before", "edges", "shape")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)

    def worth(i: Column) -> Column:
        digit = F.substring(turned, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$")
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "number":
        return _luhn(match)
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return match.rlike(STRICT[kind]) if kind in STRICT else F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _spans(kind: str, text: Column) -> Column:
    """All matches of a kind, in order: start and end in code points, votes, length class.

    The text between matches gives both the places of the matches and the words before them.
    """
    pattern = KINDS[kind]
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def one(i: Column, all_: Column) -> Column:
        match, before, after = F.get(all_["found"], i), F.get(all_["between"], i), F.get(all_["between"], i + 1)
        left, right = F.right(before, F.lit(24)), F.left(after, F.lit(1))
        length, valid = F.length(match), _valid(kind, match)
        listed = match.rlike(GAZETTEER[kind]) if kind in GAZETTEER else F.lit(False)
        named = kind in ("email", "secret", "tel")
        digits = _digits(match)
        # Secrets have digits among the letters; numbers have more than one digit.
        various = F.length(F.replace(digits, F.left(digits, F.lit(1)), F.lit(""))) > 0
        mixed = F.length(digits) >= 4 if kind == "secret" else various
        return F.struct(
            F.length(before).alias("gap"),
            length.alias("length"),
            valid.alias("valid"),
            F.lit(kind).alias("kind"),
            _vote(valid, ~valid).alias("strict"),
            _vote(listed, F.lit(named and kind != "secret") & ~listed).alias("listed"),
            _vote(left.rlike(BEFORE_PERSONAL), left.rlike(BEFORE_OTHER)).alias("before"),
            _vote(~(left.rlike("[A-Za-z0-9_]$") | right.rlike("^[A-Za-z0-9_]")), F.lit(True)).alias("edges"),
            _vote(mixed, ~mixed).alias("shape"),
            F.least(F.floor(F.log2(length)), F.lit(7)).cast("int").alias("size"),
        )

    both = F.struct(found.alias("found"), between.alias("between"))
    steps = F.aggregate(
        F.array(both),
        F.array().cast(SPAN_ARRAY),
        lambda out, b: F.concat(
            out, F.transform(F.when(F.size(b["found"]) > 0, F.sequence(F.lit(0), F.size(b["found"]) - 1)), lambda i: one(i, b))
        ),
    )
    return F.when(text.rlike(pattern), steps)


SPAN = (
    "struct<gap:int,length:int,valid:boolean,kind:string,strict:int,listed:int,before:int,edges:int,shape:int,size:int>"
)
SPAN_ARRAY = f"array<{SPAN}>"


def _placed(spans: Column) -> Column:
    """`spans` as (start, end, rest): the gaps and lengths before a span add up to its start."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(
        spans,
        empty,
        lambda s, x: F.struct(
            (s["at"] + x["gap"] + x["length"]).alias("at"),
            F.concat(s["starts"], F.array(s["at"] + x["gap"])).alias("starts"),
        ),
        lambda s: s["starts"],
    )
    return F.zip_with(
        starts,
        spans,
        lambda a, x: F.struct(
            a.alias("start"),
            (a + x["length"]).alias("end"),
            x["valid"].alias("valid"),
            *[x[v].alias(v) for v in ("kind", *VOTES, "size")],
        ),
    )


def candidates(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per document with the candidate spans of each kind, null where there are none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # Every kind needs a digit or an @; most texts have neither.
    rows = df.select(F.col(id_col).alias("doc_id"), F.when(text.rlike("[0-9@]"), text).alias("text"))
    needs = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+")}
    spans = rows.select(
        "doc_id",
        *[
            F.when(needs.get(k, F.lit(True)), _spans(k, F.col("text"))).alias(k) for k in KINDS
        ],
    )
    return spans.select("doc_id", *[_placed(F.col(k)).alias(k) for k in KINDS])


def _sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def expectation_maximisation(
    patterns: Sequence[tuple[str, tuple[int, ...]]], counts: Sequence[int], rounds: int = 50
) -> list[float]:
    """The probability that spans of each (kind, votes) are personal data.

    Labelers vote independently given the truth; a labeler's chances of each vote are the same for all
    kinds, the chance of a span being personal is each kind's own. It starts from the majority.
    """
    sure = [_sigmoid(1.5 * sum(votes)) for _, votes in patterns]
    kinds = sorted({k for k, _ in patterns})
    for _ in range(rounds):
        prior = {}
        for kind in kinds:
            own = [(p, n) for (k, _), p, n in zip(patterns, sure, counts, strict=True) if k == kind]
            prior[kind] = (sum(p * n for p, n in own) + 1) / (sum(n for _, n in own) + 2)
        chance: list[dict[tuple[bool, int], float]] = []
        for j in range(len(VOTES)):
            weight = {(truth, v): 1.0 for truth in (True, False) for v in (-1, 0, 1)}
            # A labeler is taken to be right more often than wrong, as if it had been seen a few times.
            weight[True, 1] += 4.0
            weight[False, -1] += 4.0
            for (_, votes), p, n in zip(patterns, sure, counts, strict=True):
                weight[True, votes[j]] += p * n
                weight[False, votes[j]] += (1 - p) * n
            sums = {t: sum(weight[t, v] for v in (-1, 0, 1)) for t in (True, False)}
            chance.append({(t, v): weight[t, v] / sums[t] for t, v in weight})
        sure = []
        for kind, votes in patterns:
            odds = math.log(prior[kind] / (1 - prior[kind]))
            odds += sum(math.log(chance[j][True, v] / chance[j][False, v]) for j, v in enumerate(votes))
            sure.append(_sigmoid(odds))
    return sure


def features(kind: str, votes: Sequence[int], size: int) -> list[float]:
    return [1.0, *[float(kind == k) for k in KINDS], *map(float, votes), *[float(size == s) for s in range(1, 8)]]


def logistic(rows: Sequence[list[float]], targets: Sequence[float], counts: Sequence[int], rounds: int = 400) -> list[float]:
    """Weights of a logistic regression with a slight pull to 0, by gradient descent over counted rows."""
    weights = [0.0] * len(rows[0])
    total = sum(math.sqrt(n) for n in counts)
    for _ in range(rounds):
        slope = [0.002 * w for w in weights]
        for x, target, n in zip(rows, targets, counts, strict=True):
            # Frequent patterns count more, but do not drown the others.
            miss = (_sigmoid(sum(a * b for a, b in zip(x, weights, strict=True))) - target) * math.sqrt(n) / total
            for i, value in enumerate(x):
                if value:
                    slope[i] += miss * value
        weights = [w - 2.0 * s for w, s in zip(weights, slope, strict=True)]
    return weights


def train(found: DataFrame) -> list[float]:
    """The span classifier's weights, from the votes on all spans of all documents."""
    everything = F.concat(*[F.coalesce(F.col(k), F.array().cast(PLACED)) for k in KINDS])
    votes = found.select(F.explode(everything).alias("x")).select("x.*")
    counted = votes.groupBy("kind", *VOTES, "size").agg(F.count("*").alias("n"))
    rows = sorted(tuple(r) for r in counted.collect())
    if not rows:
        return [0.0] * len(features("", (0,) * len(VOTES), 0))
    patterns = [(r[0], r[1:-2]) for r in rows]
    counts = [r[-1] for r in rows]
    sure = expectation_maximisation(patterns, counts)
    return logistic([features(r[0], r[1:-2], r[-2]) for r in rows], sure, counts)


PLACED = (
    "array<struct<start:int,end:int,valid:boolean,kind:string,strict:int,listed:int,before:int,edges:int,shape:int,size:int>>"
)


def _score(weights: Sequence[float], kind: str, x: Column) -> Column:
    """The classifier's log odds as a column."""
    kinds, sizes = list(KINDS), weights[1 + len(KINDS) + len(VOTES) :]
    total = F.lit(weights[0] + weights[1 + kinds.index(kind)])
    for i, vote in enumerate(VOTES):
        total = total + F.lit(weights[1 + len(kinds) + i]) * x[vote]
    return total + F.get(F.array(F.lit(0.0), *[F.lit(w) for w in sizes]), x["size"])


def _listed(spans: Column) -> Column:
    named = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    return F.coalesce(named, F.array().cast("array<string>"))


def _is_added(weights: Sequence[float], kind: str):
    """Whether a span of another kind is taken for personal data and lies apart from the base spans."""

    def added(x: Column) -> Column:
        meets = F.exists(F.col("base"), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
        return (_score(weights, kind, x) >= 0) & ~meets

    return added


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, a digest of their spans, and all spans.

    A span is kind:start:end, in code points, the end exclusive; `spans` lists the base kinds first,
    then those that the classifier adds, which never overlap a base span. A null text is empty.
    Repeated rows, and rows without an identifier, each give a row; other columns are ignored.
    """
    found = stored(candidates(df, id_col, text_col), "spans")
    weights = train(found)
    base = {k: F.filter(F.col(k), lambda x: x["valid"]) for k in BASE}
    rows = found.select("doc_id", *[base[k].alias(k) for k in BASE], *OTHER)
    every = F.concat(*[F.coalesce(F.col(k), F.array().cast(PLACED)) for k in BASE])
    rows = rows.withColumn("base", every)
    added = [F.filter(F.col(k), _is_added(weights, k)) for k in OTHER]
    base_list = _listed(F.col("base"))
    return rows.select(
        "doc_id",
        *[F.coalesce(F.size(F.col(k)), F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.array_join(base_list, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base_list, *[_listed(a) for a in added]), ",").alias("spans"),
    )
