"""N-gram Jaccard join with a token-group matrix.

Two documents are linked when their sets of word shingles have a Jaccard similarity of a given
percentage or more. All links count, none is lost; what is returned are the components they form.

*Tokens.* A set's hashes are cut into as many slots as there can be differences between two linked
sets of that size, and a few more. The hash of what a set has in one slot is a token. Linked sets
therefore have equal tokens in some slots: at least one that is not empty, or both sets have so many
empty slots that those are tokens too. Sets of different sizes share slots by size classes.

*Groups.* Documents that meet in a token have the smallest of them as its leader (first within a portion
of some MB of text, so that a token's leaders are never more than the portions); each is compared with the leaders it met
most often. That finds most links. Documents that
lead to the same document, by the leader each met most often, are a family; its portions of about `PORTION`
shingles are the groups.

*Matrix.* Where a token still holds documents of several components, its rows (token, group) are the
matrix in which documents look up the groups that hold larger components; a document that is linked
to a member has a known number of tokens in common with its group. Such a group is stored as the union
of its members' shingles with their owners. Only where the overlap of a query with the union
suffices is the group opened, and its members' overlaps counted. Documents already known to be connected
are not compared again, and of the links found in a group those stay that connect something: fewer than it has
documents, however many pairs are linked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import portions, stored, text_bytes
from stockyard.llm.components import components, merged
from stockyard.llm.words import mixed, sequences, words_of

SHINGLE, PERCENT = 4, 85
# Shingles in a group's sets together, and queries that are brought to one copy of a group.
PORTION, QUERIES = 1 << 18, 1024
# Of the leaders that a document has met, so many it met most often are compared with it at once.
LEADERS = 2
# Doublings of the way from a document over its leader, and that one's leader, to its family's first.
WAY = 3
TEXT_PER_STEP = 1 << 22


def sets_of(data: np.ndarray, bounds: np.ndarray, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = words_of(data, bounds, lower=True)
    every = sequences(words.hash, shingle)
    for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if last - first >= shingle:
            yield np.unique(every[first : last - shingle + 1])
        elif last > first:
            yield sequences(words.hash[first:last], last - first) ^ np.uint64(last - first)
        else:
            yield every[:0]


def least_common(a: int, b: int, percent: int) -> int:
    """The smallest intersection with which sets of these sizes are linked."""
    return -(-percent * (a + b) // (100 + percent))


def size_classes(percent: int, most: int = 1 << 40) -> list[tuple[int, int, int]]:
    """(smallest size, most differences, slots) of each class; no slots where linked sets must be equal."""
    out, low = [], 1
    while low <= most:
        high = max(low, low * 27 // 20)
        # Of two sets in a class; the count of differences goes up and down by one as sizes grow.
        both = range(max(2, 2 * high - 200), 2 * high + 1)
        differences = max(s - 2 * least_common(s, 0, percent) for s in both)
        out.append((low, differences, differences + 2 + differences // 8 if differences > 0 else 0))
        low = high + 1
    return out


class Slots:
    """The tokens of sets."""

    def __init__(self, percent: int):
        self.classes = size_classes(percent)
        self.percent = percent
        self.lows = np.array([c[0] for c in self.classes])

    def _filled(self, hashes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """The classes whose sets a set can be linked with: class, slots that are equal at least in two
        linked sets, the slots the set fills, and where in the sorted hashes each begins."""
        n = len(hashes)
        own = int(np.searchsorted(self.lows, n, "right")) - 1
        for k in range(own, len(self.classes)):
            low, differences, slots = self.classes[k]
            # The set meets sets of class k only if it is not too small for the least of them.
            if k > own and 100 * n < self.percent * low:
                break
            if slots and n:
                slot = ((hashes >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)
                starts = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
                yield k, slots - differences, slot[starts], starts

    def least_equal(self, hashes: np.ndarray) -> int:
        """So many equal tokens a set has with every set it is linked with."""
        sure = [equal - (self.classes[k][2] - len(used)) for k, equal, used, _ in self._filled(hashes)]
        return max(1, min(sure, default=1))

    def tokens(self, hashes: np.ndarray) -> np.ndarray:
        out = []
        for k, equal, used, starts in self._filled(hashes):
            seed = np.uint64((k + 1) << 40)
            out.append(mixed(mixed(used + seed) ^ np.add.reduceat(mixed(hashes), starts)))
            # All slots that are equal may be empty ones.
            slots = self.classes[k][2]
            if slots - len(used) >= equal:
                empty = np.setdiff1d(np.arange(slots, dtype=np.uint64), used)
                out.append(mixed(mixed(empty + seed) + np.uint64(1)))
        return np.concatenate(out) if out else hashes[:0]


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    slots = Slots(percent)
    for batch in batches:
        data, bounds = text_bytes(batch["text"])
        sizes, prints, equal = [], [], []
        for first, last in portions(bounds, TEXT_PER_STEP):
            low, high = bounds[first], bounds[last]
            for own in sets_of(data[low:high], bounds[first : last + 1] - low, shingle):
                sizes.append(len(own))
                prints.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                equal.append(slots.least_equal(own))
        columns = [batch["id"], pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(equal, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "n_shingles", "print", "least_equal"])


def _tokens(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    """(token, id, leader): each token once with its leader among the texts of a portion as id and leader,
    and once for each other document that has it. What is held at a time is bounded by the portion's bytes."""
    slots = Slots(percent)
    for batch in batches:
        data, bounds = text_bytes(batch["text"])
        ids = batch["id"].to_numpy(zero_copy_only=False)
        seen: set[bytes] = set()
        for first, last in portions(bounds, TEXT_PER_STEP):
            low, high = bounds[first], bounds[last]
            keys, of = [], []
            for i, own in enumerate(sets_of(data[low:high], bounds[first : last + 1] - low, shingle), first):
                # Equal sets are linked without tokens; one of them stands for all in this batch.
                same = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                if len(own) and same not in seen:
                    seen.add(same)
                    found = slots.tokens(own)
                    keys.append(found)
                    of.append(np.full(len(found), ids[i], np.int64))
            if keys:
                yield from _led(np.concatenate(keys).view(np.int64), np.concatenate(of))


def _led(key: np.ndarray, doc: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key[:0]
    leader = np.repeat(doc[starts], np.diff(np.append(starts, len(key))))
    for low in range(0, len(key), 1 << 16):
        part = slice(low, low + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(x[part]) for x in (key, doc, leader)], ["token", "id", "leader"])


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows ordered by token, leaders first: those that share a token with another document."""
    last_key, last_leader = None, None
    for batch in batches:
        key, doc, leader = (batch[c].to_numpy() for c in ("token", "id", "leader"))
        if not len(key):
            continue
        leads = doc == leader
        # The first leader of each token leads; a token may have begun in the batch before.
        k, d = key[leads], doc[leads]
        out = [(key[~leads], doc[~leads], leader[~leads])]
        if len(k):
            opens = np.concatenate([[k[0] != last_key], k[1:] != k[:-1]])
            chief = np.where(opens, d, 0)
            at = np.maximum.accumulate(np.where(opens, np.arange(len(k)), -1))
            chief = np.where(at >= 0, d[at], last_leader if last_leader is not None else 0)
            joins = (~opens) & (d != chief)
            out.append((k[joins], d[joins], chief[joins]))
            last_key, last_leader = int(k[-1]), int(chief[-1])
        columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["token", "id", "leader"])


class Group:
    """Some documents' sets as a matrix: for each token of their union, the members that have it.

    Documents of one label are known to be connected. `labels` are those of the members as links are found, `into`
    tells which label another one has become part of.
    """

    def __init__(self, ids: list[int], labels: list[int], sets: list[np.ndarray]):
        self.ids, self.labels, self.into = np.array(ids), np.array(labels), {}
        self.sizes = np.array([len(s) for s in sets])
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        self.owner = np.repeat(np.arange(len(sets)), self.sizes)[order]
        tokens = tokens[order]
        self.start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        self.union = tokens[self.start]
        self.count = np.diff(np.append(self.start, len(tokens)))

    def linked(self, label: int, own: np.ndarray, percent: int) -> np.ndarray:
        """Of the members linked with a set, one for each label that it was not known to be connected with.

        So there are fewer links than labels, not one for each pair of linked documents.
        """
        while label in self.into:
            label = self.into[label]
        place = np.minimum(np.searchsorted(self.union, own), len(self.union) - 1)
        place = place[self.union[place] == own]
        # Whatever the member, it has no more in common with the set than the union has.
        smallest = max(int(self.sizes.min()), -(-percent * len(own) // 100))
        if len(place) < least_common(len(own), smallest, percent):
            return self.ids[:0]
        counts = self.count[place]
        ends = np.cumsum(counts)
        at = np.repeat(self.start[place] - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)
        common = np.bincount(self.owner[at], minlength=len(self.ids))
        near = 100 * common >= percent * (len(own) + self.sizes - common)
        new = np.flatnonzero(near & (self.labels != label))
        if not len(new):
            return self.ids[:0]
        joined, first = np.unique(self.labels[new], return_index=True)
        self.into.update(dict.fromkeys(joined.tolist(), label))
        self.labels[np.isin(self.labels, joined)] = label
        return self.ids[new[first]]


def _opened(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows ordered by group, members before queries: links (query, member) that connect all that are linked."""
    group, members, matrix = None, [], None
    for batch in batches:
        data, bounds = text_bytes(batch["text"])
        groups, parts, labels = (batch[c].to_pylist() for c in ("gid", "part", "label"))
        queries, ids = batch["query"].to_pylist(), batch["id"].to_pylist()
        a, b = [], []
        for first, last in portions(bounds, TEXT_PER_STEP):
            low, high = bounds[first], bounds[last]
            for i, own in enumerate(sets_of(data[low:high], bounds[first : last + 1] - low, shingle), first):
                if (groups[i], parts[i]) != group:
                    group, members, matrix = (groups[i], parts[i]), [], None
                if not queries[i]:
                    members.append((ids[i], labels[i], own))
                elif members:
                    matrix = matrix or Group(*map(list, zip(*members, strict=True)))
                    near = matrix.linked(labels[i], own, percent).tolist()
                    a += [ids[i]] * len(near)
                    b += near
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _open(queries: DataFrame, members: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links that connect `queries` with all `members` of their groups that they are linked with, both (id, label, gid, part)."""
    asked = queries.withColumn("query", F.lit(True)).unionByName(members.withColumn("query", F.lit(False)))
    rows = asked.join(texts, "id").select("gid", "part", "query", "id", "label", "text")
    ordered = rows.repartition("gid", "part").sortWithinPartitions("gid", "part", "query", "id")
    return ordered.mapInArrow(lambda batches: _opened(batches, shingle, percent), "a long, b long")


def _spread(queries: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with `part`: the queries of a group in portions, and its members once for each portion."""
    sizes = queries.groupBy("gid").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"))
    sizes = stored(sizes, "portions")
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part")
    asked = queries.join(sizes, "gid").select("id", "label", "gid", part)
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    return asked, members.join(sizes, "gid").select("id", "label", "gid", every)


def jaccard_components(
    df: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: the size of its shingle set, and its component.

    Words are parted by white space after lower-casing A-Z; a text of fewer words than a shingle has
    all of them as its one shingle. The component is the smallest identifier that links lead to. A null
    text, or one without words, has the size 0 and is linked with nothing. Rows of the same identifier
    are one node, with a row each. A row without an identifier is in no component (null). Other columns
    are ignored; an empty table gives an empty result.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = "id long, n_shingles long, print binary, least_equal int"
    sized = stored(docs.mapInArrow(lambda b: _fingerprints(b, shingle, percent), schema), "fingerprints")
    known = sized.filter("id IS NOT NULL AND n_shingles > 0")
    least = known.groupBy("print").agg(F.min("id").alias("b"), F.max("id").alias("most")).filter("b < most")
    equal = known.join(least, "print").filter("id <> b").select(F.col("id").alias("a"), "b")

    present = docs.filter("id IS NOT NULL")
    schema = "token long, id long, leader long"
    rows = present.mapInArrow(lambda b: _tokens(b, shingle, percent), schema)
    # Leaders of a token meet in one partition; the others have met theirs and are spread out.
    leads = F.col("id") == F.col("leader")
    spread = rows.repartition("token", F.when(leads, F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)) + 1))
    ordered = spread.sortWithinPartitions("token", "id")
    met = stored(ordered.mapInArrow(_meetings, schema), "meetings")
    pairs = stored(met.groupBy("id", "leader").agg(F.count("*").alias("n")), "pairs")

    wanted = pairs.select("id").union(pairs.select("leader")).distinct()
    # The wanted documents are a share of all, so they are no broadcast however few they are here.
    texts = stored(present.join(wanted.hint("merge"), "id", "left_semi"), "texts")
    often = F.sort_array(F.collect_list(F.struct("n", (-F.col("leader")).alias("less"))), asc=False)
    best = pairs.groupBy("id").agg(F.slice(often, 1, LEADERS).alias("best"))
    best = stored(best.select("id", F.explode("best.less").alias("less")).select("id", (-F.col("less")).alias("leader")), "best")
    starred = best.select("id", F.col("id").alias("label"), F.col("leader").alias("gid"))
    heads = best.select(F.col("leader").alias("id"), F.col("leader").alias("label"), F.col("leader").alias("gid"))
    links = stored(_open(*_spread(starred, heads.distinct()), texts, shingle, percent), "links")
    found = components(links.union(equal))
    rest = _apart(met, pairs, found, sized)
    if rest is not None:
        more = stored(_open(*_spread(*rest), texts, shingle, percent), "links")
        found = found if more.isEmpty() else merged(found, more)
    joined = sized.select("id", "n_shingles").join(found, F.col("id") == F.col("node"), "left")
    return joined.select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component", "id").alias("component_id")
    )


def _apart(
    met: DataFrame, pairs: DataFrame, found: DataFrame, sized: DataFrame
) -> tuple[DataFrame, DataFrame] | None:
    """Queries and members still to be compared: documents that share a token, but no component."""
    nodes = pairs.select("id").union(pairs.select(F.col("leader").alias("id"))).distinct()
    labels = nodes.join(found.withColumnsRenamed({"node": "id"}), "id", "left")
    labels = labels.select("id", F.coalesce("component", "id").alias("label"))
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    labels = stored(labels.join(sizes, "label").select("id", "label", F.struct("size", "label").alias("rank")), "labels")
    mine, theirs = labels.select("id", "label"), labels.select(F.col("id").alias("leader"), F.col("label").alias("other"))
    apart = pairs.join(mine, "id").join(theirs, "leader").filter("label <> other").select("id", "leader")
    apart = stored(apart, "apart")
    if apart.isEmpty():
        return None
    tokens = stored(met.join(apart, ["id", "leader"], "left_semi").select("token").distinct(), "open-tokens")
    open_ = met.join(tokens, "token", "left_semi")
    seats = open_.select("token", "id").union(open_.select("token", F.col("leader").alias("id"))).distinct()
    known = sized.groupBy("id").agg(F.min("least_equal").alias("least"), F.max("n_shingles").alias("width"))
    # A document with fewer such tokens than a link guarantees has none left to find.
    counts = seats.groupBy("id").agg(F.count("*").alias("n")).join(known, "id").filter("n >= least")
    seats = stored(seats.join(labels.join(counts.select("id"), "id", "left_semi"), "id"), "seats")
    # Groups: portions of families. A family's documents lead, by the leader each met most often, to the same
    # one; a leader is smaller than those it leads, so that the way ends.
    own = pairs.groupBy("id").agg(F.max(F.struct("n", (-F.col("leader")).alias("less"))).alias("m"))
    family = labels.join(own, "id", "left").select("id", "label", F.coalesce(-F.col("m.less"), "id").alias("family"))
    family = stored(family, "families")
    for _ in range(WAY):
        ahead = family.select(F.col("id").alias("family"), F.col("family").alias("next"))
        family = family.join(ahead, "family").select("id", "label", F.col("next").alias("family"))
    family = stored(family.join(known, "id"), "families")
    portions_ = family.groupBy("family").agg(F.ceil(F.sum("width") / PORTION).alias("parts"))
    gid = F.xxhash64("family", F.pmod(F.xxhash64("id"), F.col("parts")))
    groups = stored(family.join(portions_, "family").select("id", "label", gid.alias("gid")), "groups")
    # The matrix at the size of tokens: which groups have a token, and the highest component there.
    matrix = seats.join(groups.select("id", "gid"), "id").groupBy("token", "gid").agg(F.max("rank").alias("highest"))
    # A document looks up the groups that hold one of a larger component; so each pair is met once. Only
    # groups with as many of its tokens as a linked document has can hold one.
    met_by = seats.join(matrix, "token").filter(F.col("rank") < F.col("highest"))
    overlap = met_by.groupBy("id", "label", "gid").agg(F.count("*").alias("n"))
    queries = overlap.join(family.select("id", "least"), "id").filter("n >= least").select("id", "label", "gid")
    queries = stored(queries, "queries")
    return queries, groups.join(queries.select("gid").distinct(), "gid", "left_semi")
