"""What must not grow with the texts: shuffles of plans, and steps that agree with their forms for larger inputs."""

import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import bias, dedup, pii, probe
from corpusmill.plans import pipeline, registry
from corpusmill.sources import lexicon


def shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture(scope="module")
def batch(spark):
    draw = random.Random(3)
    words = ["alpha", "beta", "Гама", "delta", "epsilon", "zeta", "eta", "theta", "😀iota", "kappa"]
    old = [" ".join(draw.choices(words, k=draw.randint(1, 30))) for _ in range(60)]
    new = [t if draw.random() < 0.2 else t[: -draw.randint(1, 6)] + draw.choice(["", "x", "yz"]) for t in old * 3]
    new += ["novel text without any of them", "abcd"]
    frame = lambda rows: spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    return frame(new), dedup.corpus_lines(frame(new), "doc_id"), dedup.corpus_lines(frame(old), "doc_id")


def both_ways(monkeypatch, make):
    small = sorted(make().collect())
    monkeypatch.setattr(probe, "CORPUS_AT_ONCE", 0)
    return small, sorted(make().collect())


def test_restricted_sets_shuffle_each_text_once(batch, monkeypatch):
    _, new, old = batch
    # one for the distinct lines
    assert shuffles(dedup.restricted_sets(new, old)[0]) == 1
    small, large = both_ways(monkeypatch, lambda: dedup.restricted_sets(new, old)[0].select("line", F.array_sort("shingles")))
    assert small == large and len(small) > 30


def test_similar_texts_shuffle_only_matches(batch, monkeypatch):
    _, new, old = batch
    # one for the distinct pairs, none that texts or shingles go through
    assert shuffles(dedup.similar_texts(new, old)) == 1
    for threshold in (0.5, 0.9):
        small, large = both_ways(monkeypatch, lambda t=threshold: dedup.similar_texts(new, old, t))
        assert small == large and len(small) > 30
        monkeypatch.undo()


def test_probe_in_blocks(batch, monkeypatch):
    _, new, old = batch
    whole = sorted(dedup.similar_texts(new, old, 0.5).collect())
    corpus = probe.load(dedup.shingle_sets(old))
    lines = new.select("line", dedup.hashed_shingles("line").alias("shingles")).toArrow().combine_chunks().to_batches()[0]
    monkeypatch.setattr(probe, "NUMBERS_AT_ONCE", 7)
    got = probe.Similar(corpus, dedup.share(0.5))(lines).to_pylist()
    assert sorted({tuple(r.values()) for r in got}) == [tuple(r) for r in whole]


def test_signatures_are_the_hashes_of_spark(spark):
    rows = spark.createDataFrame([("a", [3, -7, 2**62]), ("b", [0])], "line string, shingles array<bigint>")
    least = lambda k: F.array_min(F.transform("shingles", lambda s: F.xxhash64(s, F.lit(k))))
    assert sorted(dedup.signatures(rows, 9).collect()) == sorted(rows.select("line", F.array(*[least(k) for k in range(9)])).collect())


def test_similar_sketches_shuffle_only_matches(batch, monkeypatch):
    _, new, old = batch
    assert shuffles(dedup.similar_sketches(new, old)) == 1
    monkeypatch.setattr(probe, "HASHES_KEPT", 0)
    unkept = sorted(dedup.similar_sketches(new, old).collect())
    small, large = both_ways(monkeypatch, lambda: dedup.similar_sketches(new, old))
    assert small == large == unkept and len(small) > 30


def test_duplicate_pairs_move_no_texts_of_lines(batch):
    _, new, old = batch
    pairs = dedup.duplicate_pairs(new, old, dedup.similar_texts(new, old))
    lines, held = [tuple(r) for r in new.collect()], [tuple(r) for r in old.collect()]
    alike = {(r.new_line, r.corpus_line) for r in dedup.similar_texts(new, old).collect()}
    want = sorted((f, n, g, m) for f, n, x in lines for g, m, y in held if (x, y) in alike)
    assert sorted(tuple(r) for r in pairs.select("new_file", "new_line", "corpus_file", "corpus_line").collect()) == want
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert not [row for row in plan.splitlines() if "Exchange hashpartitioning(new_text" in row or "Exchange hashpartitioning(corpus_text" in row]


def test_flagged_lines_are_joined_without_texts(batch):
    _, new, old = batch
    similar = dedup.similar_texts(new, old)
    gone = dedup.flagged(new, similar).select("file", "line_no")
    plan = gone._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(line" not in plan
    alike = {r.new_line for r in similar.collect()}
    assert sorted(r.file for r in gone.collect()) == sorted(r.file for r in new.collect() if r.line in alike)


def test_remove_flagged_moves_documents_and_marks_only(spark):
    docs = spark.createDataFrame(
        [(1, "first line\r\nsecond line\n\nab"), (2, "first line\n \n"), (3, "kept as it is\r\n"), (4, None), (5, ""), (6, "tiny\nfirst line")], "doc_id int, text string"
    )
    gone = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (6, 1), (6, 2), (7, 1)], "doc_id int, line_no int")
    out = dedup.remove_flagged(docs, gone)
    # marks once, documents once; lines are not exploded
    assert shuffles(out) == 2 and "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in out.collect()) == [(1, "second line\n\nab\n", 1), (3, "kept as it is\r\n", 0), (4, None, 0), (5, "", 0), (6, "tiny\n", 1)]


def test_bias_scores_move_no_sentences(spark, monkeypatch):
    draw = random.Random(5)
    rows = ["word\tPOS\tsignal\ttype\tvalue\tderog\tcolloq\tflag\tpos\tneg\tforms"]
    rows += ["her\tN\ttrue\tgender\t\tfalse\tfalse\t1\t0\t0\ther own|a b c|ж", "bad\tA\tfalse\t\tnegative\ttrue\tfalse\t1\t0\t0.9\tb|b  c", "odd\tN\ttrue\tage\tnegative\tfalse\ttrue\t1\t0\t0\to"]
    rows += ["one of\tN\tTRUE\treligion\tpositive\tfalse\ttrue\t1\t0.7\t0\t", "own\tA\tfalse\treligion\tneutral\tfalse\ttrue\t1\tx\t0.2\tc d"]
    index = bias.form_index(lexicon.parse_lexicon(spark.createDataFrame(list(enumerate(rows)), "line_no int, value string")))
    words = ["Her", "own", "a", "b", "c", "d", "-", "12", "ж", "o", "one", "of", "bad", "x", "yy", "b,", "(c"]
    texts = [draw.choice(["", " ", "- "]) + draw.choice([" ", "  ", "\t"]).join(draw.choices(words, k=draw.randint(1, 60))) for _ in range(150)]
    own = spark.createDataFrame(list(enumerate([*texts, None, "", "...", "- -", "x " * 30 + "her " * 40 + "bad"])), "i int, sentence string")
    make = lambda: bias.score_sentences(own, index, "i")
    names = sorted(make().columns)
    assert shuffles(make()) == 0
    kinds = make().select(*names).schema.simpleString()
    fast = {r.i: r for r in make().select(*names).collect()}
    monkeypatch.setattr(bias, "FORMS_AT_ONCE", 0)
    slow = make().select(*names)
    assert slow.schema.simpleString() == kinds
    slow = {r.i: r for r in slow.collect()}
    assert fast == slow and sum(r.totalCoverage > 0 for r in slow.values()) > 50


def test_bias_report_reads_sentences_once(spark):
    own = registry.queries()["k11_bias_report"](spark, "/root/testdata/sf0.001")
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert shuffles(own) == 0 and plan.count("Scan parquet") == 1 and own.count() > 0


def test_pipeline_joins_no_sentences(spark):
    docs = spark.createDataFrame([(1, "One sentence of 01.02.2003 and more. Two of them are here!"), (2, "the other the one is of the kind\n\nthat"), (3, "")], "doc_id int, text string")
    index = lexicon.parse_lexicon(spark.createDataFrame(list(enumerate(registry.LEXICON)), "line_no int, value string"))
    done = pipeline.run(docs, pipeline.PipelineConfig(remove_duplicates=True), docs, docs.limit(0), None, index)
    plan = done.records._jdf.queryExecution().executedPlan().toString()
    assert "sent_no" in plan and not [row for row in plan.splitlines() if "Exchange" in row and "sent_no" in row]
    kept = {r.doc_id: r for r in done.records.collect()}
    assert set(kept) == {"1", "2"} and kept["1"].NumberSentences == len(kept["1"].PersonallyIdentifiableInformation) == len(kept["1"].BiasedInformation) == 2
    assert kept["1"].PersonallyIdentifiableInformation == [1 / 6, 0.0]


def test_a_copy_of_the_policy_skips_sentences_too(spark):
    own = spark.createDataFrame([("no data in this one",), ("mail a@b.cc to me",), ("years 12 years old",)], "sentence string")
    plain, copied = pii.score_sentences(own), pii.score_sentences(own, policy=dict(pii.POLICY))
    named = pii.score_sentences(own, policy=pii.policy_with_people(["this one"]))
    has = lambda df: pii.HINT[:6] in df._jdf.queryExecution().executedPlan().toString()
    assert has(plain) and has(copied) and not has(named)
    assert sorted(r.piiTokens for r in copied.collect()) == sorted(r.piiTokens for r in plain.collect()) == [0, 1, 3]
    assert max(r.piiTokens for r in named.where("sentence like 'no%'").collect()) == 2
