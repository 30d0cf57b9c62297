"""Small tests of the curation operators on hand-computed literals."""

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import sentences, text
from corpusmill.operators import bias, clean, counts, dedup, metadata, pii
from corpusmill.plans import pipeline, registry
from corpusmill.sources import conllup, description, lexicon


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, t {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_lines(spark):
    got = values(spark, text.java_lines("t"), ["a\nb", "a\r\nb\r", "", "a b\u0085c", "\n", None, "x\n\n"])
    assert got == [["a", "b"], ["a", "b"], [], ["a", "b", "c"], [""], None, ["x", ""]]


def test_trim_and_blank(spark):
    assert values(spark, text.java_trim("t"), [" \t\x01a b\n ", " a ", ""]) == ["a b", " a ", ""]
    assert values(spark, text.is_blank("t"), ["", " \t", " ", " ", "x", " "]) == [True, True, False, True, False, False]


def test_splits(spark):
    assert values(spark, text.split_space("t"), ["a  b ", " a", "", "  "]) == [["a", "b"], ["", "a"], [""], []]
    assert values(spark, F.size(text.split_on_space("t")), ["a  b ", "", "  ", " a"]) == [3, 1, 0, 2]
    assert values(spark, text.split_tabs("t"), ["a\t\tb\t\t", "\t", ""]) == [["a", "", "b"], [], [""]]
    assert values(spark, text.split_tabs("t", True), ["a\t"]) == [["a", ""]]
    assert values(spark, text.estimate_tokens("t"), ["a, b  c."]) == [6]
    assert values(spark, text.count_tokens("t"), ["a, b  c."]) == [5]


def test_shingles(spark):
    assert values(spark, text.shingles("t"), ["AbcdeF", "abc", "aaaaaaa"]) == [["abcde", "bcdef"], [], ["aaaaa"]]


def test_sentences(spark):
    got = values(spark, sentences.split_text("t"), ["One is. Two is! Three is?", "Hi.", "", None, "Dr. Who came. So.", "no end"])
    assert got == [["One is.", "Two is!", "Three is?"], ["Hi."], [], [], ["Dr. Who came.", "So."], ["no end"]]
    assert values(spark, sentences.split_and_filter("t", 2), ["One is. Two. Three is."]) == [["One is.", "Three is."]]
    assert values(spark, sentences.document_sentences("t"), ["a b\nc d. E f.\n\n"]) == [["a b", "c d.", "E f."]]
    assert values(spark, sentences.sentence_probabilities("t"), ["One is. Two is."]) == [[None, None]]


PATTERN_CASES = {
    "P01": ("<div>", "a <div>"), "P02": ("x <header> y", "head"), "P03": ("a </body>", "</b>"), "P04": ("<!-- x -->", "<!-- x"),
    "P05": ("a &nbsp; b", "a & b"), "P06": ("<?php x", "php"), "P07": ("a ?>", "a ? >"), "P08": ("<% a %>", "<%"),
    "P09": ("начало", "Начало"), "P10": ("Next", "next page"), "P11": ("| a | b |", "| a"), "P12": (">> x", "A > B > C"),
    "P14": ("see http://a.b", "http:/a"), "P15": ("www.a.b", "www.a"), "P16": ("ftp://x", "ftp:x"), "P17": ("a@b.cd", "a@b"),
    "P18": ("We decline it", "refuse"), "P19": ("Tweet", "tweets are"), "P20": ("google-analytics", "googleanalytics"),
    "P21": ("ga('x", "gab"), "P22": ("gtag (x", "gtags"), "P23": ("_gaq.push", "gaq"), "P24": ("страница 1 от 5", "страница"),
    "P25": ("Page 3 of 9", "page x"), "P26": ("© me", "me ©"), "P27": ("All rights reserved.", "not all rights reserved"),
    "P28": ("права запазени", "Права"), "P29": ("***---", "*a*"),
}


def test_patterns(spark):
    for name, (yes, no) in PATTERN_CASES.items():
        assert values(spark, F.col("t").rlike(clean.PATTERNS[name]), [yes, no]) == [True, False], name
    assert values(spark, text.java_trim("t").rlike(clean.PATTERNS["P13"]), ["1. 2. 3. ", "1 2 3"]) == [False, False]


def test_blocklist_and_cleaning(spark):
    docs = spark.createDataFrame([(1, "join us\nalpha\nalpha\nhi"), (2, "join us\nbeta\n"), (3, None), (4, ""), (5, "plain")], "doc_id int, text string")
    listed = clean.learn_blocklist(docs, 0.4)
    assert [tuple(r) for r in listed.collect()] == [("join us", 2)]
    assert clean.learn_blocklist(docs, 0.41).count() == 0
    got = {r.doc_id: (r.text, r.lines_removed) for r in clean.clean(docs, listed).collect()}
    assert got == {1: ("alpha\nalpha\nhi\n", 1), 2: ("beta\n", 1), 3: (None, 0), 4: ("", 0), 5: ("plain", 0)}
    parsed = clean.parse_blocklist(clean.render_blocklist(listed, 0.4))
    assert [r.line for r in parsed.collect()] == ["join us"]
    raw = spark.createDataFrame([("# c",), ("",), ("3\ta\tb",), ("bare ",)], "value string")
    assert sorted(r.line for r in clean.parse_blocklist(raw).collect()) == ["a\tb", "bare"]
    with pytest.raises(ValueError):
        clean.learn_blocklist(docs, 1.5)
    again = clean.clean(clean.clean(docs, listed).select("doc_id", "text"), listed)
    assert again.where("lines_removed > 0").count() == 0


def test_counts(spark):
    docs = spark.createDataFrame([(1, "One is. Two, is.\n\n\nThree"), (2, ""), (3, "\n a\n")], "doc_id int, text string")
    got = {r.doc_id: tuple(r)[1:] for r in counts.sentence_counts(docs).collect()}
    assert got == {1: (3, 5, 8), 2: (0, 0, 0), 3: (1, 1, 1)}
    assert {r[0]: r[1] for r in counts.paragraph_counts(docs).collect()} == {1: 2, 2: 1, 3: 1}


def sides(spark, new, old):
    make = lambda rows: dedup.corpus_lines(spark.createDataFrame(rows, "doc_id int, text string"), "doc_id")
    return make(new), make(old)


def test_line_dedup(spark):
    base = "the quick brown fox jumps over the lazy dog again and again today"
    new, old = sides(spark, [(1, base.upper() + "\nhey"), (2, "zzzzz yyyyy"), (3, base + " QQQQQQ")], [(9, base), (8, base)])
    similar = dedup.similar_texts(new, old)
    # the tail's shingles are outside the corpus, so it does not lower the similarity
    assert {(r.new_line[:3], r.shared == r.joint) for r in similar.collect()} == {("THE", True), ("the", True)}
    pairs = dedup.duplicate_pairs(new, old, similar)
    assert pairs.count() == 4
    sketched = dedup.similar_sketches(new, old)
    assert {r.new_line for r in sketched.collect()} == {r.new_line for r in similar.collect()}
    rows = dedup.report(pairs).collect()
    assert [r.NEW_FILE for r in rows] == [1, 1, 3, 3] and rows[0].SIMILARITY == "1.0000"
    docs = spark.createDataFrame([(1, base.upper() + "\nhey"), (3, base + " QQQQQQ"), (4, "")], "doc_id int, text string")
    gone = dedup.flagged(new, similar).select(F.col("file").alias("doc_id"), "line_no")
    assert {r.doc_id: r.text for r in dedup.remove_flagged(docs, gone).collect()} == {1: "hey\n", 4: ""}
    assert dedup.bands_for(200, 0.9) == 25


def test_pii(spark):
    rows = ["mail me at a.b@c.org now", "call +1 (555) 123-4567 today please", "ip 10.0.0.1 or 999.1.1.1 ok", "card 4111 1111 1111 1111 end", "card 4111 1111 1111 1112 end", "a@b.cd x"]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, sentence string")
    got = {r.i: (r.totalWords, r.piiTokens, dict(r.typeFrequency)) for r in pii.score_sentences(df).collect()}
    assert got[0] == (5, 1, {"emailAddress": 1})
    assert got[1] == (6, 3, {"phoneNumber": 3})
    assert got[2] == (5, 1, {"ipAddress": 1})
    assert got[3][1] == 4 and got[4][1] == 0 and got[5] == (2, 0, {})
    checks = spark.createDataFrame([("GB82 WEST 1234 5698 7654 32", "1M8GDM9AXKP042788"), ("GB82 WEST 1234 5698 7654 33", "1M8GDM9A1KP042788")], "i string, v string")
    assert [tuple(r) for r in checks.select(pii.mod97(F.col("i")), pii.vin_check(F.col("v"))).collect()] == [(True, True), (False, False)]
    people = pii.policy_with_people(["Ada Byron"], {})
    named = spark.createDataFrame([("here is Ada Byron today",)], "sentence string")
    assert pii.score_sentences(named, policy=people).first().piiTokens == 2


def lex(spark):
    rows = ["h", "жена\tN\ttrue\tgender\t\tfalse\tfalse\t1\t0\t0\tжени", "лоша\tA\tfalse\t\tnegative\tfalse\tfalse\t1\t0\t0\t", "стара мома\tN\ttrue\tgender\tnegative\ttrue\tfalse\t1\t0\t0\t",
            "мома\tN\tfalse\tage\tnegative\tfalse\tfalse\t1\t0\t0\tжена"]
    return lexicon.parse_lexicon(spark.createDataFrame(list(enumerate(rows)), "line_no int, value string"))


def test_bias(spark):
    index = bias.form_index(lex(spark))
    rows = ["Една лоша жена дойде тук днес", "жена сама", "тя е стара мома от село тук", "жена – 5 а б в г д", "жена а б в г д е ж з и лоша", "жена а б в г д е ж з и й лоша"]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, sentence string")
    got = {r.i: r for r in bias.score_sentences(df, index, "i").collect()}
    assert (got[0].totalWords, got[0].gender_signals, got[0].gender_evaluators) == (6, 1, 1) and got[0].gender_coverage == pytest.approx(2 / 6)
    assert got[0].matchedLemmas == ["лоша", "жена"] and not got[0].multiType
    assert got[1].totalCoverage == 0 and got[1].totalWords == 2
    assert got[2].gender_signals == 2 and got[2].gender_coverage == pytest.approx(2 / 7) and got[2].totalDerogatory == 2
    # a form followed by empty tokens takes them with it
    assert got[3].totalWords == 8 and got[3].gender_signals == 3
    assert got[4].gender_coverage > 0 and got[5].gender_coverage == 0
    assert bias.form_conflicts(lex(spark)).first()[0] == 1
    assert bias.lookup(spark.createDataFrame([(" ЖЕНИ ",), (None,), ("",)], "key string"), index).count() == 1
    assert bias.signals(lex(spark), "Gender").count() == 2


def test_metadata(spark):
    rows = [("a_meta.json", '{"Identifier":"bg_a","NumberWords":"12.0","Domain":"x","BiasedInformation":[0.5,"q"],"TranslatedDocument":"no"}'), ("a.json", "{}"),
            ("b.json", '{"Licence":"CC0","Author":"me","NumberWords":7,"Keywords":"k"}'), ("c_meta.json", "not json")]
    files = spark.createDataFrame(rows, "file_name string, json string")
    stems = spark.createDataFrame([("a",), ("b",), ("c",)], "stem string")
    got = {r.stem: r for r in metadata.load_or_create(stems, files).collect()}
    assert (got["a"].NumberWords, got["a"].Domain, got["a"].BiasedInformation, got["a"].TranslatedDocument) == (0, ["x"], [0.5], False)
    assert (got["b"].Identifier, got["b"].Licence, got["b"].Author, got["b"].NumberWords, got["b"].Keywords) == ("b", "CC0", ["me"], 7, [])
    assert got["c"].Medium == "textual" and got["c"].TranslatedDocument is None
    out = metadata.load_or_create(stems, files).where("stem = 'c'").select(metadata.to_json().alias("j")).first().j
    assert '"TranslatedDocument":""' in out and '"Domain":[]' in out


def test_csv(spark):
    df = spark.createDataFrame([(0, '{"a":"x,y","b":"q\\"r"}'), (1, '{"a":null,"c":"l\\nm"}'), (2, "5")], "row_no long, json string")
    got = [r.value for r in metadata.csv_rows(df).orderBy("row_no").collect()]
    assert got == ["a,b,c", '"x,y","q""r",', ',,"l\nm"']
    assert metadata.csv_rows(df.where("row_no = 2")).count() == 0


CONLL = "# title = A\n# title = # title = B \n# newpar id = 1\n# sent_id = 1\n# text = Hi there\na\tb\tc\tNOUN\te\tf\n.\t.\t.\tPUNCT\te\tf\na\tb\tc\td\te\na\tb\tc\td\te\t\n"


def test_conllup(spark):
    files = spark.createDataFrame([("x.conllup", CONLL), ("y", "")], "file_name string, text string")
    docs, seeds = conllup.extract_files(files, conllup.MARCELL)
    assert {r.doc_id: r.text for r in docs.collect()} == {"bg_MARCELL_x": "\nHi there\n", "bg_MARCELL_y": ""}
    got = {r.Identifier: r for r in seeds.collect()}["bg_MARCELL_x"]
    assert (got.DocumentTitle, got.NumberTokens, got.NumberWords, got.NumberSentences, got.NumberParagraphs, got.Medium) == ("B", 2, 1, 1, 1, "text")


def test_description(spark):
    row = lambda stem, path, url: "\t".join([stem, path, "2020", "", "me", "", "", "", "T", "1.2.2003", "", "", url, "false", "", "", "", "news", "", "dom"])
    rows = spark.createDataFrame([(row("a", "C-MassMedia/a.txt", "u"),), (row("b", "C-MassMedia/b.txt", "setimes"),), (row("c", "C-MassMedia/c.txt", "u"),), ("short",)], "value string")
    good, bad = description.parse_description(rows)
    assert (good.count(), bad.count()) == (3, 1)
    files = spark.createDataFrame([("C-MassMedia/a.txt", "One is. Two is.\n\nx")], "path string, text string")
    matched, missing = description.join_files(description.selected(good, description.is_mass_media), files)
    assert [r.stem for r in missing.collect()] == ["c"]
    docs, seeds = description.extract_rows(matched)
    got = seeds.first()
    assert (got.Identifier, got.Licence, got.PublicationDate, got.NumberParagraphs, got.NumberSentences) == ("bg_bnc_a", "Restricted", "1-2-2003", 3, 3)


def test_text_counts_of_lines(spark, tmp_path):
    """The query over all turns, null and many-line ones too, equals its SQL."""
    import duckdb

    texts = ["One is. Two is.\n\nx y", None, "", "\n", "A b.\r\nC d! E f?\n", "One line. Two."]
    rows = [(i // 2, i % 2, t) for i, t in enumerate(texts)]
    path = str(tmp_path / "conversations.parquet")
    spark.createDataFrame(rows, "conv_id long, turn int, text string").write.parquet(path)
    got = sorted(map(tuple, registry.queries()["s12_text_counts"](spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
    assert got == sorted(con.sql(registry.oracles()["s12_text_counts"]).fetchall())
    assert got == [(0, 6, 3, 3), (1, 0, 0, 0), (1000, 0, 0, 0), (1001, 0, 0, 1), (2000, 6, 3, 2), (2001, 3, 2, 1)]


def test_pipeline(spark):
    docs = spark.createDataFrame([(1, "Boiler line here\nOne is a test. Two is a test."), (2, "Boiler line here\nmail me at a@b.org now")], "doc_id int, text string")
    found = pipeline.run(docs, pipeline.PipelineConfig(boilerplate_threshold=0.9), sample=docs)
    got = {r.doc_id: r for r in found.records.collect()}
    assert set(got) == {"1"} and got["1"].NumberSentences == 2 and got["1"].PersonallyIdentifiableInformation == [0.0, 0.0]
    assert [r.doc_id for r in found.errors.collect()] == [2]
    with pytest.raises(ValueError):
        pipeline.PipelineConfig(dedup_threshold=2, num_hashes=0)
    with pytest.raises(ValueError):
        pipeline.run(docs)


def test_append_new(spark, tmp_path):
    from corpusmill.sources import sinks

    a = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id int, text string")
    for _ in range(2):
        sinks.append_new(a, str(tmp_path / "t"), "doc_id")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_registry_names():
    assert set(registry.oracles()) <= set(registry.queries())


def test_sentences_with_marks(spark):
    """Control characters that the splitter uses as marks are text like any other."""
    got = values(spark, sentences.split_text("t"), ["One\x01two \x02x. Three\x03a four\x03.", "\x03b Here. \x03c\x01There."])
    assert got == [["One\x01two \x02x.", "Three\x03a four\x03."], ["b Here. \x03c\x01There."]]


def test_splitter_parameter(spark):
    docs = spark.createDataFrame([(1, "a b;c. D e;f"), (2, None)], "doc_id int, text string")
    at = lambda c: F.filter(F.split(c, ";"), lambda s: s != "")
    assert [r.sentence for r in counts.sentence_rows(docs, splitter=at).orderBy("sent_no").collect()] == ["a b", "c. D e", "f"]
    assert {r.doc_id: r.NumberWords for r in counts.sentence_counts(docs, splitter=at).collect()}[1] == 6
    assert values(spark, sentences.split_and_filter("t", 2, at), ["a b;c"]) == [["a b"]]


@pytest.mark.parametrize("threshold", [0.5, 0.905, 0.9, 0.333])
def test_threshold_is_not_rounded(spark, threshold):
    words = ["abcdefghijklmnopqrstuvwxyz"[i:] + "abcdefghijklmnopqrstuvwxyz"[:i] for i in range(0, 26, 3)] + ["abcdefghijklmnopqrstuvwxy!", "abcdefghijklm", "0123456789abcdefgh"]
    new = spark.createDataFrame([("n", i, w) for i, w in enumerate(words)], "file string, line_no int, line string")
    cut = {w: {w[i : i + 5] for i in range(len(w) - 4)} for w in words}
    want = {(a, b) for a in words for b in words if len(cut[a] & cut[b]) >= threshold * len(cut[a] | cut[b])}
    assert {(r.new_line, r.corpus_line) for r in dedup.similar_texts(new, new, threshold).collect()} == want
