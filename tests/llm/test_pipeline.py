"""The pipeline's stages, one after the other, each against a plain version on its own input."""

import collections

import public_tokenizers
from cases import WORD, empty, jaccard, lowered, odd, statistics  # noqa: F401
from tokenizers import Tokenizer

import corpus_pipeline
from stockyard.llm.common import stored
from stockyard.llm.quality_rules import quality

FOLDER = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def run_stage(spark, number, docs):
    name, stage = corpus_pipeline.STAGES[number]
    return stored(stage(spark, docs, FOLDER), f"test-{name}")


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    good = run_stage(spark, 0, docs)
    assert good.columns == docs.columns
    counts = {r[0]: statistics(r[1]) for r in rows(docs)}
    passed = {d for d, (n, _, _, _, repeated) in counts.items() if n >= 50 and 100 * repeated <= 50 * n}
    kept = {r.doc_id for r in quality(docs).filter("kept").collect()}
    assert kept <= passed and len(kept) > 0.9 * len(passed)
    assert collections.Counter(rows(good)) == collections.Counter(r for r in rows(docs) if r[0] in kept)

    single = run_stage(spark, 1, good)
    assert single.columns == docs.columns
    largest = {}
    for r in rows(good):
        text = lowered(r[1])
        largest[text] = max(largest.get(text, r), r, key=lambda x: x[0])
    assert sorted(rows(single)) == sorted(largest.values())

    apart = run_stage(spark, 2, single)
    assert apart.columns == docs.columns
    first = {d for d, _, component in jaccard([(r[0], r[1]) for r in rows(single)]) if d == component}
    assert sorted(rows(apart)) == sorted(r for r in rows(single) if r[0] in first)

    drawn = run_stage(spark, 3, apart)
    assert drawn.columns == docs.columns
    words, total, used = {}, collections.Counter(), collections.Counter()
    for r in rows(apart):
        words[r[0]] = len(WORD.findall(r[1]))
        total[r[3]] += words[r[0]]
    for r in rows(drawn):
        used[r[3]] += words[r[0]]
    assert set(rows(drawn)) == set(rows(apart))
    most = max(words.values())
    for source, n in total.items():
        assert n <= used[source] <= corpus_pipeline.MOST_EPOCHS * n + 1
    smallest = min(total, key=total.get)
    assert used[smallest] > corpus_pipeline.MOST_EPOCHS * total[smallest] - most - 1

    packed = run_stage(spark, 4, drawn).collect()
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = collections.Counter()
    for r in rows(drawn):
        expected[r[0]] += len(own.encode(r[1], add_special_tokens=False).ids) + 1
    found, bins = collections.Counter(), collections.defaultdict(list)
    for r in packed:
        found[r.doc_id] += r.length
        bins[r.sequence_id].append((r.offset, r.length))
    assert found == expected
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024


def test_near_duplicates_from_80_percent_of_five_word_shingles_go(spark):
    """Pairs between this limit and op2's: 20 words appended to 100 (96 of 116), two words changed (86 of 106)."""
    docs = []
    for i in range(6):
        words = [f"w{i}x{j}" for j in range(100)]
        changed = [f"new{i}x{j}" if j in (30, 70) else w for j, w in enumerate(words)]
        # 26 words appended (96 of 122) are too many.
        near = (words + [f"more{i}x{j}" for j in range(20)], changed, words + [f"more{i}x{j}" for j in range(26)])[i % 3]
        docs += [(10 * i, " ".join(words)), (10 * i + 1, " ".join(near))]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r[0] for r in rows(run_stage(spark, 2, docs))}
    assert kept == {0, 10, 20, 21, 30, 40, 50, 51}


def test_mixing_repeats_a_small_source(spark):
    """A source 100 times smaller than the other is drawn four times, as far as whole documents fit."""
    docs = [(i, f"{i} " * 50, "en", "large", 0) for i in range(40)] + [(100, "x " * 20, "en", "small", 0)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    used = collections.Counter(r[3] for r in rows(run_stage(spark, 3, docs)))
    assert used["large"] == 40 and 3 <= used["small"] <= 4


def test_odd_rows_pass_through_all_stages(spark, odd, empty):  # noqa: F811
    for docs in (odd, empty):
        for number in range(len(corpus_pipeline.STAGES)):
            after = run_stage(spark, number, docs)
            if number < 4:
                assert after.columns == docs.columns
            docs = after
        assert "sequence_id" in docs.columns


def test_run_is_what_its_stages_make(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.count() > 100 and {"doc_id", "piece", "sequence_id", "offset"} <= set(found.columns)


def test_near_duplicates_are_judged_by_row(spark):
    """Rows of one identifier are documents of their own: an unlinked text stays, of linked ones one does."""
    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"x{i}" for i in range(60))
    rows = [(4, base), (20, base + " more"), (20, other), (21, other + " end"), (None, base), (30, "alone and short")]
    rows += [(31, f"{other} a"), (31, f"{other} b")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near(spark, docs.repartition(3), "")
    assert kept.columns == docs.columns
    found = sorted((r.doc_id or 0, r.text) for r in kept.collect())
    assert found == sorted([(0, base), (4, base), (20, other), (30, "alone and short")])
    once = docs.filter("doc_id IN (4, 30)").unionByName(docs.filter("doc_id = 20").limit(1))
    assert corpus_pipeline.near(spark, once, "").columns == docs.columns
