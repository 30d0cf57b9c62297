"""Named queries over the driver's tables, each with its DuckDB counterpart.

Names begin with the identifier of the operation they show. A "file" of the
operations is a document; thresholds are such that the tables give results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sentences, text
from ..operators import bias, clean, counts, dedup, metadata, pii
from ..sources import conllup, description, lexicon
from . import pipeline

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}

#: Share of documents from which a line counts as boilerplate in these queries.
SHARE = 0.02

LINES = r"""
lines_raw AS (
  SELECT doc_id, unnest(range(1, len(p) + 1)) AS line_no, unnest(p) AS raw
  FROM (SELECT doc_id, CASE WHEN p[len(p)] = '' THEN p[1:len(p) - 1] ELSE p END AS p
        FROM (SELECT doc_id, regexp_split_to_array(text, '\r\n|[\n\r\x{2028}\x{2029}\x{0085}]') AS p FROM documents))),
lines AS (SELECT *, regexp_replace(raw, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS line FROM lines_raw),
freq AS (SELECT line, count(DISTINCT doc_id) AS n_files FROM lines WHERE length(line) >= 3 GROUP BY line),
blocklist AS (SELECT line, n_files FROM freq WHERE n_files >= 0.02 * (SELECT count(DISTINCT doc_id) FROM documents))
"""
RE2 = {k: v.replace(r"\p{Punct}", "[:punct:]").replace("'", "''") for k, v in clean.PATTERNS.items()}
HIT = " OR ".join(f"regexp_matches(line, '{p}')" for p in RE2.values())
SPLIT = rf"""
trimmed AS (SELECT doc_id, regexp_replace(text, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS t FROM documents),
marked AS (
  SELECT doc_id, t, regexp_replace(regexp_replace(
      regexp_replace(t, '{sentences._PROTECT.replace("'", "''")}', '\1\2' || chr(2), 'g'),
      '{sentences._BOUNDARY.replace("'", "''")}', '\1' || chr(1) || '\2', 'g'),
      '{sentences._BOUNDARY.replace("'", "''")}', '\1' || chr(1) || '\2', 'g') AS m FROM trimmed),
split AS (
  SELECT doc_id, CASE WHEN t = '' THEN [] WHEN length(t) < 5 THEN [t] ELSE
    list_filter(list_transform(string_split(m, chr(1)),
      lambda s: regexp_replace(replace(s, chr(2), '.'), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')), lambda s: s <> '') END AS s
  FROM marked),
sents AS (
  SELECT doc_id, list_filter(list_transform(flatten(list_transform(s, lambda x: regexp_split_to_array(x, '\n'))),
    lambda x: regexp_replace(x, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')), lambda x: NOT regexp_full_match(x, '\s*')) AS s FROM split)
"""
WORDS = r"CASE WHEN {0} = '' THEN 1 WHEN NOT regexp_matches({0}, '\S') THEN 0 ELSE len(regexp_split_to_array(regexp_replace({0}, '\s+$', ''), '\s+')) END"
MARKS = r"(length({0}) - length(regexp_replace({0}, '[.,;:!?()\-]', '', 'g')))"
SPACED = "CASE WHEN {0} = '' THEN 1 WHEN rtrim({0}, ' ') = '' THEN 0 ELSE len(string_split(rtrim({0}, ' '), ' ')) END"


def query(name: str, oracle: str | None = None):
    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if oracle:
            _ORACLES[name] = oracle
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", "text")


# --- text primitives -------------------------------------------------------------------------


@query("j1_java_lines", f"WITH {LINES} SELECT doc_id, line_no, raw FROM lines")
def j1(spark, sf_dir):
    return clean.lines(_docs(spark, sf_dir)).select("doc_id", "line_no", "raw")


@query("j2_java_trim", f"WITH {LINES} SELECT doc_id, line_no, length(raw) - length(line) AS cut FROM lines")
def j2(spark, sf_dir):
    return clean.lines(_docs(spark, sf_dir)).select("doc_id", "line_no", (F.length("raw") - F.length("line")).alias("cut"))


@query("j3_is_blank", rf"WITH {LINES} SELECT doc_id, count(*) FILTER (WHERE regexp_full_match(raw, '\s*')) AS n_blank FROM lines GROUP BY doc_id")
def j3(spark, sf_dir):
    return clean.lines(_docs(spark, sf_dir)).groupBy("doc_id").agg(F.count_if(text.is_blank("raw")).alias("n_blank"))


@query(
    "j4_j5_splits",
    f"SELECT doc_id, {WORDS.format('text')} AS n_words, {SPACED.format('text')} AS n_spaced FROM documents",
)
def j4(spark, sf_dir):
    own = _docs(spark, sf_dir)
    return own.select("doc_id", text.word_count("text").alias("n_words"), F.size(text.split_on_space("text")).alias("n_spaced"))


@query("a4_estimate_tokens", f"SELECT conv_id, turn, {SPACED.format('text')} + {MARKS.format('text')} AS n_tokens FROM conversations")
def a4(spark, sf_dir):
    return _t(spark, sf_dir, "conversations").select("conv_id", "turn", text.estimate_tokens("text").alias("n_tokens"))


# --- boilerplate -----------------------------------------------------------------------------


@query("a1_learn_blocklist", f"WITH {LINES} SELECT line, n_files FROM blocklist")
def a1(spark, sf_dir):
    return clean.learn_blocklist(_docs(spark, sf_dir), SHARE)


@query("a1_line_frequency", f"WITH {LINES} SELECT line, n_files FROM freq")
def a1_frequency(spark, sf_dir):
    return clean.line_frequency(_docs(spark, sf_dir))


@query("o3_top_common_lines", f"WITH {LINES} SELECT line, n_files FROM freq ORDER BY n_files DESC, line LIMIT 20")
def o3(spark, sf_dir):
    return clean.top_lines(clean.line_frequency(_docs(spark, sf_dir)), 20)


@query(
    "c1_pattern_hits",
    f"WITH {LINES} SELECT pattern, n FROM (SELECT "
    + ", ".join(f"count(*) FILTER (WHERE regexp_matches(line, '{p}')) AS {k}" for k, p in RE2.items())
    + f" FROM lines WHERE length(line) >= 3) UNPIVOT (n FOR pattern IN ({', '.join(RE2)}))",
)
def c1_patterns(spark, sf_dir):
    own = clean.lines(_docs(spark, sf_dir)).where(F.length("line") >= clean.SHORTEST)
    row = own.agg(*[F.count_if(F.col("line").rlike(p)).alias(k) for k, p in clean.PATTERNS.items()])
    return row.unpivot([], list(clean.PATTERNS), "pattern", "n")


@query(
    "c1_judged_lines",
    f"WITH {LINES} SELECT doc_id, line_no, length(line) >= 3 AND (line IN (SELECT line FROM blocklist) OR {HIT}) AS removed FROM lines",
)
def c1(spark, sf_dir):
    own = _docs(spark, sf_dir)
    return clean.judged_lines(own, clean.learn_blocklist(own, SHARE)).select("doc_id", "line_no", "removed")


CLEANED = f"""{LINES},
judged AS (SELECT *, length(line) >= 3 AND (line IN (SELECT line FROM blocklist) OR {HIT}) AS removed FROM lines),
cleaned AS (SELECT doc_id, count(*) FILTER (WHERE removed) AS n,
    coalesce(string_agg(raw || chr(10), '' ORDER BY line_no) FILTER (WHERE NOT removed), '') AS t FROM judged GROUP BY doc_id)"""


@query(
    "c2_clean_documents",
    f"WITH {CLEANED} SELECT d.doc_id, CASE WHEN n > 0 THEN t ELSE text END AS text, coalesce(n, 0) AS lines_removed FROM documents d LEFT JOIN cleaned c ON d.doc_id = c.doc_id",
)
def c2(spark, sf_dir):
    own = _docs(spark, sf_dir)
    return clean.clean(own, clean.learn_blocklist(own, SHARE))


@query(
    "clean_doc_counts",
    f"WITH {CLEANED}, c2 AS (SELECT d.doc_id, CASE WHEN n > 0 THEN t ELSE text END AS x, coalesce(n, 0) AS lines_removed FROM documents d LEFT JOIN cleaned c ON d.doc_id = c.doc_id)"
    f" SELECT doc_id, lines_removed, {WORDS.format('x')} AS n_words, {WORDS.format('x')} + {MARKS.format('x')} AS n_tokens FROM c2",
)
def clean_doc_counts(spark, sf_dir):
    own = _docs(spark, sf_dir)
    cleaned = clean.clean(own, clean.learn_blocklist(own, SHARE))
    return cleaned.select("doc_id", "lines_removed", text.word_count("text").alias("n_words"), text.count_tokens("text").alias("n_tokens"))


@query(
    "k6_blocklist_file",
    f"""WITH {LINES} SELECT value FROM (VALUES ('# corpus blocklist'), ('# Format: <frequency TAB line>'), ('')) v(value)
UNION ALL SELECT '# threshold=0.02  entries=' || count(*) FROM blocklist
UNION ALL SELECT n_files || chr(9) || line FROM blocklist""",
)
def k6(spark, sf_dir):
    return clean.render_blocklist(clean.learn_blocklist(_docs(spark, sf_dir), SHARE), SHARE).select("value")


@query("s18_blocklist_parse", f"WITH {LINES} SELECT DISTINCT line FROM blocklist WHERE line <> ''")
def s18(spark, sf_dir):
    return clean.parse_blocklist(clean.render_blocklist(clean.learn_blocklist(_docs(spark, sf_dir), SHARE), SHARE))


# --- sentences and counts --------------------------------------------------------------------


@query("t1_split", f"WITH {SPLIT} SELECT doc_id, unnest(s) AS sentence FROM split")
def t1(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.explode(sentences.split_text("text")).alias("sentence"))


@query("t5_split_and_filter", f"WITH {SPLIT} SELECT doc_id, sentence FROM (SELECT doc_id, unnest(s) AS sentence FROM split) WHERE {WORDS.format('sentence')} >= 5")
def t5(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.explode(sentences.split_and_filter("text", 5)).alias("sentence"))


@query("t7_document_sentences", f"WITH {SPLIT} SELECT doc_id, unnest(range(1, len(s) + 1)) AS sent_no, unnest(s) AS sentence FROM sents")
def t7(spark, sf_dir):
    return counts.sentence_rows(_docs(spark, sf_dir))


COUNTS = (
    f'SELECT doc_id, len(s) AS "NumberSentences", CAST(coalesce(list_sum(list_transform(s, lambda x: {WORDS.format("x")})), 0) AS BIGINT) AS "NumberWords", '
    f'CAST(coalesce(list_sum(list_transform(s, lambda x: {WORDS.format("x")} + {MARKS.format("x")})), 0) AS BIGINT) AS "NumberTokens" FROM sents'
)


@query("a2_sentence_counts", f"WITH {SPLIT} {COUNTS}")
def a2(spark, sf_dir):
    return counts.sentence_counts(_docs(spark, sf_dir))


@query(
    "a9_run_totals",
    f'WITH {SPLIT}, c AS ({COUNTS}) SELECT count(*) AS documents, count(*) FILTER (WHERE "NumberSentences" = 0) AS errors, '
    'CAST(sum("NumberSentences") AS BIGINT) AS sentences, CAST(sum("NumberWords") AS BIGINT) AS words, CAST(sum("NumberTokens") AS BIGINT) AS tokens FROM c',
)
def a9(spark, sf_dir):
    return counts.run_totals(counts.sentence_counts(_docs(spark, sf_dir)))


@query(
    "a3_paragraphs",
    rf"""WITH {LINES}, b AS (SELECT doc_id, line_no, regexp_full_match(raw, '\s*') AS blank FROM lines),
s AS (SELECT doc_id, NOT blank AND coalesce(lag(blank) OVER (PARTITION BY doc_id ORDER BY line_no), true) AS start FROM b),
n AS (SELECT doc_id, count(*) FILTER (WHERE start) AS n FROM s GROUP BY doc_id)
SELECT d.doc_id, greatest(coalesce(n, 0), 1) AS "NumberParagraphs" FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id""",
)
def a3(spark, sf_dir):
    return counts.paragraph_counts(_docs(spark, sf_dir))


# --- near-duplicate lines ---------------------------------------------------------------------

SHINGLED = f"""{LINES},
new AS (SELECT doc_id, line_no, line FROM lines WHERE length(line) >= 5),
corpus AS (
  SELECT item_id, unnest(range(1, len(p) + 1)) AS line_no, regexp_replace(unnest(p), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS line
  FROM (SELECT item_id, CASE WHEN p[len(p)] = '' THEN p[1:len(p) - 1] ELSE p END AS p FROM (SELECT item_id, string_split(text, chr(10)) AS p FROM benchmark))),
old AS (SELECT * FROM corpus WHERE length(line) >= 5),
cut AS (SELECT DISTINCT line, substr(lower(line), i, 5) AS sh FROM (SELECT line, unnest(range(1, length(line) - 3)) AS i FROM (SELECT DISTINCT line FROM old))),
own AS (SELECT DISTINCT line, substr(lower(line), i, 5) AS sh FROM (SELECT line, unnest(range(1, length(line) - 3)) AS i FROM (SELECT DISTINCT line FROM new))),
kept AS (SELECT * FROM own WHERE sh IN (SELECT sh FROM cut)),
na AS (SELECT line, count(*) AS n FROM kept GROUP BY line), nb AS (SELECT line, count(*) AS n FROM cut GROUP BY line),
sim AS (SELECT k.line AS new_line, c.line AS corpus_line, count(*) AS shared FROM kept k JOIN cut c USING (sh) GROUP BY ALL),
pairs AS (SELECT new_line, corpus_line, shared, na.n + nb.n - shared AS joint FROM sim JOIN na ON na.line = new_line JOIN nb ON nb.line = corpus_line
  WHERE shared * 100 >= (na.n + nb.n - shared) * 90)"""


def _sides(spark, sf_dir):
    new = dedup.corpus_lines(_docs(spark, sf_dir), "doc_id")
    old = dedup.corpus_lines(_t(spark, sf_dir, "benchmark"), "item_id")
    return new, old


@query(
    "d1_shingles",
    f"WITH {SHINGLED} SELECT line, count(*) AS n_shingles FROM own GROUP BY line",
)
def d1(spark, sf_dir):
    own = dedup.eligible(_docs(spark, sf_dir)).select("line").distinct()
    return own.select("line", F.size(text.shingles("line")).cast("long").alias("n_shingles"))


@query("a8_vocabulary", f"WITH {SHINGLED} SELECT DISTINCT sh AS shingle FROM cut")
def a8(spark, sf_dir):
    return dedup.vocabulary(_sides(spark, sf_dir)[1])


@query("d4_restricted_sets", f"WITH {SHINGLED} SELECT line, n FROM na")
def d4(spark, sf_dir):
    return dedup.restricted_sets(*_sides(spark, sf_dir))[0].select("line", F.size("shingles").cast("long").alias("n"))


@query("d6_similar_texts", f"WITH {SHINGLED} SELECT new_line, corpus_line, shared, joint FROM pairs")
def d6(spark, sf_dir):
    return dedup.similar_texts(*_sides(spark, sf_dir))


@query("d6_similar_sketches")
def d6_sketches(spark, sf_dir):
    return dedup.similar_sketches(*_sides(spark, sf_dir))


@query(
    "a10_flagged_lines",
    f"WITH {SHINGLED} SELECT doc_id, line_no FROM new WHERE line IN (SELECT new_line FROM pairs)",
)
def a10(spark, sf_dir):
    new, old = _sides(spark, sf_dir)
    return dedup.flagged(new, dedup.similar_texts(new, old)).select(F.col("file").alias("doc_id"), "line_no")


@query(
    "k8_dedup_report",
    f"""WITH {SHINGLED} SELECT n.doc_id AS "NEW_FILE", n.line_no AS "NEW_LINE", o.item_id AS "CORPUS_FILE", o.line_no AS "CORPUS_LINE",
printf('%.4f', shared / joint) AS "SIMILARITY", n.line AS "NEW_SENTENCE", o.line AS "CORPUS_SENTENCE"
FROM pairs p JOIN new n ON n.line = p.new_line JOIN old o ON o.line = p.corpus_line""",
)
def k8(spark, sf_dir):
    new, old = _sides(spark, sf_dir)
    return dedup.report(dedup.duplicate_pairs(new, old, dedup.similar_texts(new, old)))


@query(
    "d7_remove_flagged",
    rf"""WITH {SHINGLED}, j AS (SELECT *, length(line) >= 5 AND line IN (SELECT new_line FROM pairs) AS gone FROM lines),
c AS (SELECT doc_id, count(*) FILTER (WHERE gone) AS n, bool_or(NOT gone AND NOT regexp_full_match(raw, '\s*')) AS alive,
  string_agg(raw || chr(10), '' ORDER BY line_no) FILTER (WHERE NOT gone) AS t FROM j GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN n > 0 THEN t ELSE text END AS text, coalesce(n, 0) AS lines_removed FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id
WHERE coalesce(alive, true) OR coalesce(n, 0) = 0""",
)
def d7(spark, sf_dir):
    new, old = _sides(spark, sf_dir)
    gone = dedup.flagged(new, dedup.similar_texts(new, old)).select(F.col("file").alias("doc_id"), "line_no")
    return dedup.remove_flagged(_docs(spark, sf_dir), gone)


# --- personal data ---------------------------------------------------------------------------

PII_TOKENS = r"list_filter(list_transform(regexp_split_to_array(regexp_replace(sentence, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'), '\s+'), lambda t: regexp_replace(t, '[^\p{L}\p{N}@._+\-]', '', 'g')), lambda t: t <> '')"
SENTENCES = f"{SPLIT}, rows AS (SELECT doc_id, unnest(range(1, len(s) + 1)) AS sent_no, unnest(s) AS sentence FROM sents)"


def _sentences(spark, sf_dir):
    return counts.sentence_rows(_docs(spark, sf_dir))


@query("i1_pii_tokens", f"WITH {SENTENCES} SELECT doc_id, sent_no, len({PII_TOKENS}) AS n, array_to_string({PII_TOKENS}, ' ') AS tokens FROM rows")
def i1(spark, sf_dir):
    own = _sentences(spark, sf_dir).withColumn("t", pii.pii_tokens("sentence"))
    return own.select("doc_id", "sent_no", F.size("t").cast("long").alias("n"), F.array_join("t", " ").alias("tokens"))


_PLAIN = [k for k, d in pii.POLICY.items() if d.valid is None]


@query(
    "i9_plain_detectors",
    f"WITH {SENTENCES}, s AS (SELECT *, len({PII_TOKENS}) AS n FROM rows) SELECT doc_id, sent_no, "
    + ", ".join(f"CASE WHEN n < 3 THEN 0 ELSE len(regexp_extract_all(sentence, '{pii.POLICY[k].pattern}')) END AS \"{k}\"" for k in _PLAIN)
    + " FROM s",
)
def i9(spark, sf_dir):
    scored = pii.score_sentences(_sentences(spark, sf_dir), policy={k: pii.POLICY[k] for k in _PLAIN})
    return scored.select("doc_id", "sent_no", *[pii.span_count(k).cast("long").alias(k) for k in _PLAIN])


# The detectors once more, stated for the oracle on its own: type, pattern, and what a match must pass besides.
_LUHN = """list_sum(list_transform(list_reverse(string_split(regexp_replace(h, '\\D', '', 'g'), '')),
  lambda x, i: CASE WHEN i % 2 = 0 THEN CASE WHEN x::INT * 2 > 9 THEN x::INT * 2 - 9 ELSE x::INT * 2 END ELSE x::INT END)) % 10 = 0"""
_MOD97 = """list_reduce(list_transform(string_split('0' || array_to_string(list_transform(string_split(
  substr(upper(regexp_replace(h, '\\s', '', 'g')), 5) || substr(upper(regexp_replace(h, '\\s', '', 'g')), 1, 4), ''),
  lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE (ascii(c) - 55)::VARCHAR END), ''), ''), lambda d: d::BIGINT), lambda a, d: (a * 10 + d) % 97) = 1"""
_OCTETS = "contains(h, ':') OR list_bool_and(list_transform(string_split(h, '.'), lambda x: x::INT <= 255))"
_VIN = """substr(h, 9, 1) = (['0','1','2','3','4','5','6','7','8','9','X'])[list_sum(list_transform(string_split(translate(h, 'ABCDEFGHJKLMNPRSTUVWXYZ', '12345678123457923456789'), ''),
  lambda c, i: c::INT * ([8,7,6,5,4,3,2,10,0,9,8,7,6,5,4,3,2])[i]))::INT % 11 + 1]"""
_DETECTORS = (
    ("emailAddress", r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}", "true"),
    ("phoneNumber", r"\+[0-9]{1,3}[ \-]?\(?[0-9]{2,4}\)?[ \-]?[0-9]{3}[ \-]?[0-9]{3,4}", "true"),
    ("ipAddress", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}|[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){7}", _OCTETS),
    ("url", r"https?://[^\s]+|www\.[^\s]+\.[^\s]+", "true"),
    ("creditCard", r"[0-9]{4}[ \-]?[0-9]{4}[ \-]?[0-9]{4}[ \-]?[0-9]{4}", _LUHN),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", "true"),
    ("ibanCode", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?", _MOD97),
    ("bankAccountNumber", r"(?:acct|account)[.: #]*[0-9]{8,17}", "true"),
    ("date", r"[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2}", "true"),
    ("age", r"[0-9]{1,3}[ \-](?:years?[ \-]old|годин[аи])", "true"),
    ("macAddress", r"[0-9A-Fa-f]{2}(?:[:\-][0-9A-Fa-f]{2}){5}", "true"),
    ("bitcoinAddress", r"(?:bc1|[13])[a-km-zA-HJ-NP-Z1-9]{25,39}", "true"),
    ("vin", r"[A-HJ-NPR-Z0-9]{17}", _VIN),
    ("zipCode", r"[0-9]{5}-[0-9]{4}", "true"),
)
_FOUND = " UNION ALL ".join(
    f"SELECT doc_id, sent_no, rank, type, k, start, len(h) AS size FROM (SELECT doc_id, sent_no, {rank} AS rank, '{kind}' AS type, k, hits[k] AS h, "
    "list_sum(list_transform(gaps[1:k], lambda g: len(g))) + coalesce(list_sum(list_transform(hits[1:k - 1], lambda g: len(g))), 0) AS start FROM ("
    f"SELECT doc_id, sent_no, regexp_extract_all(sentence, '{pattern}') AS hits, regexp_split_to_array(sentence, '{pattern}') AS gaps, "
    f"unnest(range(1, len(hits) + 1)) AS k FROM searched WHERE regexp_matches(sentence, '{pattern}'))) WHERE {valid}"
    for rank, (kind, pattern, valid) in enumerate(_DETECTORS)
)
PII = f"""{SENTENCES.replace('WITH ', '', 1)}, counted AS (SELECT *, {PII_TOKENS} AS t FROM rows),
searched AS (SELECT * FROM counted WHERE len(t) >= 3), found AS MATERIALIZED ({_FOUND}),
walk AS (
  SELECT doc_id, sent_no, sentence, t, 0 AS i, 0::BIGINT AS pos, 0::BIGINT AS cursor FROM searched SEMI JOIN found USING (doc_id, sent_no)
  UNION ALL
  SELECT doc_id, sent_no, sentence, t, i + 1, CASE WHEN p > 0 THEN cursor + p - 1 ELSE cursor END, CASE WHEN p > 0 THEN cursor + p - 1 + len(t[i + 1]) ELSE cursor END
  FROM (SELECT *, instr(substr(sentence, cursor + 1), t[i + 1]) AS p FROM walk WHERE i < len(t))),
typed AS (SELECT w.doc_id, w.sent_no, w.i, arg_max(f.type, f.rank * 1000000 + f.k) AS type
  FROM walk w JOIN found f ON w.doc_id = f.doc_id AND w.sent_no = f.sent_no AND w.i > 0 AND w.pos < f.start + f.size AND w.pos + len(w.t[w.i]) > f.start GROUP BY ALL),
kinds AS (SELECT doc_id, sent_no, type, count(*) AS n FROM typed GROUP BY ALL),
touched AS (SELECT doc_id, sent_no, sum(n)::INTEGER AS n, string_agg(type || '=' || n, ';' ORDER BY type) AS types, string_agg(type, ';' ORDER BY type) AS names FROM kinds GROUP BY ALL)"""


@query(
    "i7_pii_scores",
    f"""WITH RECURSIVE {PII} SELECT c.doc_id, c.sent_no, len(t)::INTEGER AS "totalWords", coalesce(n, 0)::INTEGER AS "piiTokens",
CASE WHEN len(t) = 0 THEN 0.0::DOUBLE ELSE round(coalesce(n, 0)::DOUBLE / len(t), 6) END AS "piiCoverage", coalesce(types, '') AS types
FROM counted c LEFT JOIN touched USING (doc_id, sent_no)""",
)
def i7(spark, sf_dir):
    scored = pii.score_sentences(_sentences(spark, sf_dir))
    return scored.select("doc_id", "sent_no", "totalWords", "piiTokens", F.round("piiCoverage", 6).alias("piiCoverage"), pii.type_frequency_text().alias("types"))


@query(
    "k10_pii_report",
    f"""WITH RECURSIVE {PII} SELECT c.doc_id AS file, replace(sentence, chr(9), ' ') AS sentence, len(t)::INTEGER AS "totalWords", n AS "piiTokens",
round(n::DOUBLE / len(t), 4) AS "piiCoverage", round(n::DOUBLE / len(t) * 100, 2) AS "piiCoveragePercent", names AS "distinctPiiTypes", types AS "typeFrequency"
FROM counted c JOIN touched USING (doc_id, sent_no)""",
)
def k10(spark, sf_dir):
    return pii.report(pii.score_sentences(_sentences(spark, sf_dir)), "doc_id")


# --- bias ------------------------------------------------------------------------------------

#: A synthetic lexicon of frequent words: word, pos, signal, type, value, derogatory, colloquial, flag, positivity, negativity, forms.
LEXICON = [
    "word\tPOS\tsignal\ttype\tvalue\tderog\tcolloq\tflag\tpos\tneg\tforms",
    "the\tN\ttrue\tgender\t\tfalse\tfalse\t1\t0\t0\tthem|then",
    "and\tA\tfalse\t\tnegative\tfalse\tfalse\t1\t0\t0.9\tands",
    "of the\tN\ttrue\treligion\tpositive\tfalse\tfalse\t1\t0.7\t0\t",
    "that\tA\tfalse\tgender\tneutral\ttrue\tfalse\t1\t0\t0\tthat|these",
    "in\tN\tTRUE\tdisability\t\tfalse\ttrue\t1\tx\t0\tinto|the",
    "und\tA\tfalse\tappearance\tpositive\tfalse\tfalse\t1\t0\t0\t",
    "die\tN\ttrue\tappearance\t\tfalse\tfalse\t1\t0\t0\tder",
    "que\tN\ttrue\trace_ethnicity\tnegative\tfalse\tfalse\t1\t0\t0\tlos|las",
    "is\tA\tfalse\tage\tnegative\tfalse\tfalse\t1\t0\t0\tare",
    "the\tN\tfalse\treligion\tnegative\tfalse\tfalse\t1\t0\t0\tthere",
    "",
    "short\tN\ttrue\tgender",
]


def _lexicon(spark) -> DataFrame:
    rows = spark.createDataFrame(list(enumerate(LEXICON)), "line_no int, value string")
    return lexicon.parse_lexicon(rows)


_VALUES = ", ".join(f"({i}, '{row}')" for i, row in enumerate(LEXICON)).replace("\t", "' || chr(9) || '")
LEX = rf"""
raw AS (SELECT i AS line_no, string_split(v, chr(9)) AS f FROM (VALUES {_VALUES}) t(i, v) WHERE i > 0 AND v <> ''),
lex AS (SELECT line_no, f[1] AS word, lower(f[3]) = 'true' AS signal, f[4] AS bias_type, f[5] AS bias_value, coalesce(try_cast(f[9] AS DOUBLE), 0) AS positivity,
  list_distinct(list_filter(list_concat([lower(f[1])], list_transform(string_split(coalesce(f[11], ''), '|'), lambda x: lower(trim(x)))), lambda x: x <> '')) AS forms
  FROM raw WHERE len(f) >= 10),
form_rows AS (SELECT line_no, word, unnest(forms) AS form FROM lex)
"""


@query("s17_lexicon", f"WITH {LEX} SELECT line_no, word, signal, bias_type, bias_value, CAST(positivity AS DOUBLE) AS positivity, array_to_string(list_sort(forms), '|') AS forms FROM lex")
def s17(spark, sf_dir):
    return _lexicon(spark).select("line_no", "word", "signal", "bias_type", "bias_value", "positivity", F.array_join(F.array_sort("forms"), "|").alias("forms"))


@query("d12_form_index", f"WITH {LEX} SELECT form, min(line_no) AS line_no FROM form_rows GROUP BY form")
def d12(spark, sf_dir):
    return bias.form_index(_lexicon(spark)).select("form", "line_no")


@query("d11_lemma_index", f"WITH {LEX} SELECT lower(word) AS lemma, max(line_no) AS line_no FROM lex GROUP BY ALL")
def d11(spark, sf_dir):
    return bias.lemma_index(_lexicon(spark)).select("lemma", "line_no")


@query("b1_bias_tokens", rf"""WITH {SENTENCES} SELECT doc_id, sent_no, array_to_string(list_transform(
regexp_split_to_array(regexp_replace(lower(sentence), '\s+$', ''), '\s+'), lambda t: regexp_replace(t, '[^\p{{L}}\s]', '', 'g')), '|') AS tokens FROM rows""")
def b1(spark, sf_dir):
    return _sentences(spark, sf_dir).select("doc_id", "sent_no", F.array_join(bias.bias_tokens("sentence"), "|").alias("tokens"))


@query("d10_form_lookup", rf"""WITH {SENTENCES}, {LEX}, tok AS (SELECT doc_id, regexp_replace(unnest(regexp_split_to_array(lower(sentence), '\s+')), '[^\p{{L}}\s]', '', 'g') AS form FROM rows)
SELECT form, count(*) AS n FROM tok WHERE form IN (SELECT form FROM form_rows) GROUP BY form""")
def d10(spark, sf_dir):
    own = _sentences(spark, sf_dir).select(F.explode(bias.bias_tokens("sentence")).alias("key"))
    return bias.lookup(own, bias.form_index(_lexicon(spark))).groupBy("form").agg(F.count(F.lit(1)).alias("n"))


def _biased(spark, sf_dir):
    own = _sentences(spark, sf_dir).withColumn("sid", F.struct("doc_id", "sent_no"))
    return bias.score_sentences(own, bias.form_index(_lexicon(spark)), "sid")


_TYPES = ("gender", "race_ethnicity", "religion", "disability", "appearance")
BIAS = rf"""{SENTENCES.replace('WITH ', '', 1)}, {LEX.strip()},
full_lex AS (SELECT r.line_no, f[1] AS word, lower(f[3]) = 'true' AS signal, f[4] AS bias_type, f[5] NOT IN ('', 'neutral') AS evaluative,
  lower(f[6]) = 'true' AS derogatory, lower(f[7]) = 'true' AS colloquial,
  f[5] NOT IN ('', 'neutral') OR lower(f[6]) = 'true' OR lower(f[7]) = 'true' OR coalesce(try_cast(f[9] AS DOUBLE), 0) > 0.5 OR coalesce(try_cast(f[10] AS DOUBLE), 0) > 0.5 AS modifier
  FROM raw r WHERE len(f) >= 10),
forms AS (SELECT form, min(line_no) AS line_no FROM form_rows GROUP BY form),
tok AS (SELECT doc_id, sent_no, sentence, list_transform(regexp_split_to_array(regexp_replace(lower(sentence), '\s+$', ''), '\s+'), lambda t: regexp_replace(t, '[^\p{{L}}\s]', '', 'g')) AS t FROM rows),
places AS (SELECT doc_id, sent_no, t, unnest(range(0, len(t))) AS pos FROM tok),
grams AS (SELECT doc_id, sent_no, pos, n, trim(array_to_string(t[pos + 1:pos + n], ' ')) AS form FROM places, (VALUES (1), (2), (3)) v(n) WHERE pos + n <= len(t)),
hits AS MATERIALIZED (SELECT doc_id, sent_no, pos, max(n) AS n, arg_max(line_no, n) AS line_no FROM grams JOIN forms USING (form) WHERE form <> '' GROUP BY ALL),
taken AS (
  SELECT doc_id, sent_no, min(pos) AS pos, arg_min(n, pos) AS n, arg_min(line_no, pos) AS line_no FROM hits GROUP BY ALL
  UNION ALL
  SELECT h.doc_id, h.sent_no, min(h.pos), arg_min(h.n, h.pos), arg_min(h.line_no, h.pos) FROM taken s JOIN hits h ON h.doc_id = s.doc_id AND h.sent_no = s.sent_no AND h.pos >= s.pos + s.n GROUP BY h.doc_id, h.sent_no),
inside AS (SELECT doc_id, sent_no, unnest(range(pos, pos + n)) AS pos, line_no FROM taken),
emitted AS (SELECT p.doc_id, p.sent_no, i.line_no, row_number() OVER (PARTITION BY p.doc_id, p.sent_no ORDER BY p.pos) AS i
  FROM places p LEFT JOIN inside i ON i.doc_id = p.doc_id AND i.sent_no = p.sent_no AND i.pos = p.pos WHERE p.t[p.pos + 1] <> '' OR i.line_no IS NOT NULL),
sized AS (SELECT doc_id, sent_no, count(*) AS words FROM emitted GROUP BY ALL),
matched AS (SELECT e.doc_id, e.sent_no, e.i, l.* FROM emitted e JOIN sized z ON z.doc_id = e.doc_id AND z.sent_no = e.sent_no AND z.words >= 6 JOIN full_lex l ON l.line_no = e.line_no),
lemmas AS (SELECT doc_id, sent_no, string_agg(word, ';' ORDER BY i) AS lemmas FROM (SELECT doc_id, sent_no, word, min(i) AS i FROM matched GROUP BY ALL) GROUP BY ALL),
totals AS (SELECT doc_id, sent_no, count(*) FILTER (WHERE evaluative) AS b, count(*) FILTER (WHERE derogatory) AS d, count(*) FILTER (WHERE colloquial) AS c FROM matched GROUP BY ALL),
by_kind AS (SELECT doc_id, sent_no, i, signal, modifier, unnest(CASE WHEN bias_type <> '' THEN [bias_type] ELSE {list(_TYPES)} END) AS kind FROM matched),
paired AS (SELECT a.doc_id, a.sent_no, a.kind, a.i, any_value(a.signal) AS signal, any_value(a.modifier) AS modifier,
  any_value(a.signal) AND (any_value(a.modifier) OR coalesce(bool_or(b.modifier), false)) OR any_value(a.modifier) AND coalesce(bool_or(b.signal), false) AS paired
  FROM by_kind a LEFT JOIN by_kind b ON a.doc_id = b.doc_id AND a.sent_no = b.sent_no AND a.kind = b.kind AND a.i <> b.i AND abs(a.i - b.i) <= 10 GROUP BY a.doc_id, a.sent_no, a.kind, a.i),
wide AS (SELECT doc_id, sent_no, {", ".join(f"count(*) FILTER (WHERE signal AND kind = '{t}') AS {t}_s, count(*) FILTER (WHERE modifier AND paired AND kind = '{t}') AS {t}_m, count(*) FILTER (WHERE paired AND kind = '{t}') AS {t}_p" for t in _TYPES)} FROM paired GROUP BY ALL),
biased AS (SELECT k.doc_id, k.sent_no, k.sentence, coalesce(words, 0)::INTEGER AS words, coalesce(lemmas, '') AS lemmas, coalesce(b, 0)::INTEGER AS b, coalesce(d, 0)::INTEGER AS d, coalesce(c, 0)::INTEGER AS c,
  {", ".join(f"coalesce({t}_{x}, 0)::INTEGER AS {t}_{x}" for t in _TYPES for x in "sm")}, {", ".join(f"coalesce({t}_p / words, 0)::DOUBLE AS {t}_c" for t in _TYPES)}
  FROM tok k LEFT JOIN sized USING (doc_id, sent_no) LEFT JOIN lemmas USING (doc_id, sent_no) LEFT JOIN totals USING (doc_id, sent_no) LEFT JOIN wide USING (doc_id, sent_no)),
scored AS (SELECT *, {" + ".join(f"{t}_c" for t in _TYPES)} AS cover, {" + ".join(f"({t}_c > 0)::INT" for t in _TYPES)} >= 2 AS multi FROM biased)"""


@query(
    "b12_bias_scores",
    f"""WITH RECURSIVE {BIAS} SELECT doc_id, sent_no, words AS "totalWords", {", ".join(f'{t}_s AS "{t}_signals", {t}_m AS "{t}_evaluators"' for t in _TYPES)},
b AS "totalBiasWords", d AS "totalDerogatory", c AS "totalColloquial", multi AS "multiType", round(cover, 6) AS "totalCoverage" FROM scored""",
)
def b12(spark, sf_dir):
    cols = [f"{t}_{k}" for t in bias.TYPES for k in ("signals", "evaluators")]
    return _biased(spark, sf_dir).select("doc_id", "sent_no", "totalWords", *cols, "totalBiasWords", "totalDerogatory", "totalColloquial", "multiType", F.round("totalCoverage", 6).alias("totalCoverage"))


@query(
    "k11_bias_report",
    f"""WITH RECURSIVE {BIAS} SELECT doc_id AS file, sentence, words AS "totalWords", lemmas AS "matchedLemmas",
{", ".join(f'{t}_s AS "{t}_signals", {t}_m AS "{t}_evaluators", round({t}_c, 4) AS "{t}_coverage"' for t in _TYPES)},
b AS "totalBiasWords", d AS "totalDerogatory", c AS "totalColloquial", multi::INTEGER AS "multiType", round(cover, 4) AS "totalCoverage" FROM scored WHERE cover > 0""",
)
def k11(spark, sf_dir):
    return bias.report(_biased(spark, sf_dir), "doc_id")


# --- annotated and described sources ----------------------------------------------------------


def _conll_files(spark, sf_dir):
    own = clean.lines(_docs(spark, sf_dir))
    tokens = F.transform(text.split_space("line"), lambda w: F.concat_ws("\t", w, w, w, F.when(w.rlike(r"\.$"), "PUNCT").otherwise("NOUN"), F.lit("_"), F.lit("_x")))
    block = F.concat_ws("\n", F.concat(F.lit("# sent_id = "), F.col("line_no").cast("string")), F.concat(F.lit("# text = "), "line"), F.array_join(tokens, "\n"))
    body = own.where("line <> ''").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("line_no", block.alias("b")))).alias("b"))
    head = F.concat(F.lit("# title = Doc "), F.col("doc_id").cast("string"), F.lit("\n# title = Last "), F.col("doc_id").cast("string"), F.lit("\n# newpar id = p1\n"))
    return body.select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".conllup")).alias("file_name"),
        F.concat(head, F.array_join(F.transform("b", lambda x: x["b"]), "\n")).alias("text"),
    )


CONLL = rf"""{LINES}, good AS (SELECT doc_id, line_no, line, regexp_split_to_array(line, '\s+') AS w FROM lines WHERE line <> '')"""


@query(
    "s5_conll_counts",
    rf"""WITH {CONLL} SELECT 'bg_MARCELL_d' || doc_id AS "Identifier", 'Last ' || doc_id AS "DocumentTitle", CAST(sum(len(w)) AS BIGINT) AS "NumberTokens",
CAST(sum(len(list_filter(w, lambda x: NOT regexp_matches(x, '\.$')))) AS BIGINT) AS "NumberWords", count(*) AS "NumberSentences", 1 AS "NumberParagraphs" FROM good GROUP BY doc_id""",
)
def s5(spark, sf_dir):
    _, seeds = conllup.extract_files(_conll_files(spark, sf_dir), conllup.MARCELL)
    return seeds.select("Identifier", "DocumentTitle", *[F.col(k).cast("long").alias(k) for k in ("NumberTokens", "NumberWords", "NumberSentences", "NumberParagraphs")])


@query(
    "s4_conll_text",
    rf"""WITH {CONLL} SELECT 'bg_CURLICAT_d' || doc_id AS doc_id, chr(10) || string_agg(line || chr(10), '' ORDER BY line_no) AS text FROM good GROUP BY doc_id""",
)
def s4(spark, sf_dir):
    docs, _ = conllup.extract_files(_conll_files(spark, sf_dir), conllup.CURLICAT)
    return docs.select("doc_id", "text")


def _description(spark, sf_dir):
    own = _t(spark, sf_dir, "customer")
    part = F.element_at(F.array(*[F.lit(x) for x in ("A-Administrative/", "B-Science/", "C-MassMedia/", "D-Fiction/", "F-InformalFiction/")]), (F.pmod("c_custkey", F.lit(5)) + 1).cast("int"))
    cells = {0: F.col("c_custkey").cast("string"), 1: F.concat(part, F.col("c_custkey").cast("string"), F.lit(".txt")), 4: F.col("c_name"), 9: F.lit("2001.02.03"),
             12: F.when(F.pmod("c_nationkey", F.lit(5)) == 0, "http://www.setimes.com/x").otherwise("http://x.example/"), 19: F.lit("News")}
    return own.select(F.concat_ws("\t", *[cells.get(i, F.lit("")) for i in range(20)]).alias("value"))


DESCRIBED = """d AS (SELECT c_custkey::VARCHAR AS stem, ['A-Administrative/', 'B-Science/', 'C-MassMedia/', 'D-Fiction/', 'F-InformalFiction/'][c_custkey % 5 + 1] || c_custkey || '.txt' AS path,
  c_name, c_nationkey % 5 = 0 AS listed FROM customer)"""


@query(
    "s8_description_select",
    f"""WITH {DESCRIBED} SELECT stem, path, c_name AS "Author", '2001-02-03' AS "PublicationDate" FROM d WHERE path LIKE '%C-MassMedia/%' AND NOT listed""",
)
def s8(spark, sf_dir):
    rows, _ = description.parse_description(_description(spark, sf_dir))
    return description.selected(rows, description.is_mass_media).select("stem", "path", "Author", description.normal_date("PublicationDate").alias("PublicationDate"))


@query(
    "s9_licences",
    f"""WITH {DESCRIBED} SELECT stem, CASE WHEN path LIKE 'B-%' OR path LIKE 'C-%' OR path LIKE 'D-%' THEN 'Restricted' ELSE 'CC0' END AS licence FROM d""",
)
def s9(spark, sf_dir):
    rows, _ = description.parse_description(_description(spark, sf_dir))
    return rows.select("stem", description.licence(F.col("path"))[0].alias("licence"))


@query(
    "s12_text_counts",
    rf"""WITH turns AS (SELECT conv_id * 1000 + turn AS doc_id, text FROM conversations), {LINES.replace("FROM documents", "FROM turns")},
pieces AS (SELECT {{'turn': doc_id, 'line': line_no}} AS doc_id, raw AS text FROM lines_raw), {SPLIT.replace("FROM documents", "FROM pieces")},
counted AS (SELECT doc_id.turn AS doc_id, list_sum(list_transform(s, lambda x: {SPACED.format('x')})) AS w, len(s) AS n FROM split)
SELECT doc_id, CAST(coalesce(sum(w), 0) AS BIGINT) AS "NumberWords", CAST(coalesce(sum(n), 0) AS INTEGER) AS "NumberSentences", CAST(count(n) AS INTEGER) AS "NumberParagraphs"
FROM turns LEFT JOIN counted USING (doc_id) GROUP BY doc_id""",
)
def s12(spark, sf_dir):
    turns = _t(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
    return description.text_counts(turns).select("doc_id", F.col("NumberWords").cast("long").alias("NumberWords"), "NumberSentences", "NumberParagraphs")


# --- metadata --------------------------------------------------------------------------------


def _nation_json(spark, sf_dir):
    own = _t(spark, sf_dir, "nation")
    number = F.when(F.pmod("n_nationkey", F.lit(3)) == 0, F.lit("12.0")).otherwise(F.col("n_nationkey").cast("string"))
    fields = F.struct(
        F.concat(F.lit("bg_"), "n_name").alias("Identifier"),
        F.when(F.col("n_regionkey") == 0, "").otherwise("CC0").alias("Licence"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(', "x" ')).alias("DocumentTitle"),
        number.alias("NumberWords"),
        F.array(F.col("n_name"), F.lit("b")).alias("Keywords"),
        F.lit("Law").alias("Domain"),
        F.when(F.col("n_regionkey") == 1, "TRUE").otherwise("").alias("TranslatedDocument"),
    )
    return own.select(F.col("n_nationkey").cast("long").alias("row_no"), F.to_json(fields).alias("json"))


@query(
    "g3_parse_record",
    """SELECT 'bg_' || n_name AS "Identifier", CASE WHEN n_regionkey = 0 THEN '' ELSE 'CC0' END AS "Licence", n_name || ', "x"' AS "DocumentTitle",
CASE WHEN n_nationkey % 3 = 0 THEN 0 ELSE n_nationkey END::BIGINT AS "NumberWords", n_name || '|b' AS "Keywords", 'Law' AS "Domain",
CASE WHEN n_regionkey = 1 THEN true END AS "TranslatedDocument" FROM nation""",
)
def g3(spark, sf_dir):
    own = _nation_json(spark, sf_dir).select(*metadata.parse_record("json"))
    return own.select("Identifier", "Licence", "DocumentTitle", F.col("NumberWords").cast("long").alias("NumberWords"), F.array_join("Keywords", "|").alias("Keywords"), F.array_join("Domain", "|").alias("Domain"), "TranslatedDocument")


@query(
    "g4_merge_legacy",
    """SELECT 'doc' || n_nationkey AS stem, 'doc' || n_nationkey AS "Identifier", CASE WHEN n_regionkey = 0 THEN '' ELSE 'CC0' END AS "Licence", 'textual' AS "Medium",
CASE WHEN n_nationkey % 3 = 0 THEN 0 ELSE n_nationkey END::BIGINT AS "NumberWords", 0 AS n_keywords, 'Law' AS "Domain" FROM nation""",
)
def g4(spark, sf_dir):
    own = _nation_json(spark, sf_dir)
    stem = F.concat(F.lit("doc"), F.col("row_no").cast("string"))
    base = own.select(stem.alias("stem"), "json").select("stem", "json", *metadata.skeleton(F.col("stem")))
    out = metadata.merge_legacy(base, "json")
    return out.select("stem", "Identifier", "Licence", "Medium", F.col("NumberWords").cast("long").alias("NumberWords"), F.size("Keywords").cast("long").alias("n_keywords"), F.array_join("Domain", "|").alias("Domain"))


@query(
    "g5_missing_mandatory",
    """SELECT 'bg_' || n_name AS "Identifier", CASE WHEN n_regionkey = 0 THEN 'Licence,' ELSE '' END || 'Medium' || CASE WHEN n_nationkey % 3 = 0 THEN ',NumberWords' ELSE '' END
|| ',NumberSentences,NumberParagraphs,NumberTokens' AS missing FROM nation""",
)
def g5(spark, sf_dir):
    own = _nation_json(spark, sf_dir).select(*metadata.parse_record("json"))
    return own.select("Identifier", F.array_join(metadata.missing_mandatory(), ",").alias("missing"))


@query(
    "g6_violations",
    """SELECT field, rule, count(*) AS n FROM (
SELECT 'Licence' AS field, 'enum' AS rule FROM nation WHERE n_regionkey = 0 UNION ALL SELECT 'Medium', 'enum' FROM nation
UNION ALL SELECT 'Domain', 'items' FROM nation) GROUP BY ALL""",
)
def g6(spark, sf_dir):
    own = _nation_json(spark, sf_dir).select(*metadata.parse_record("json"))
    return metadata.violations(own).groupBy("field", "rule").agg(F.count(F.lit(1)).alias("n"))


@query(
    "k3_csv_rows",
    """SELECT -1::BIGINT AS row_no, 'k,n,v' AS value UNION ALL SELECT n_nationkey, n_nationkey || ',' || CASE WHEN n_regionkey = 0 THEN '' ELSE n_name END || ',"a,' || chr(34) || chr(34) || n_name || chr(34) || chr(34) || chr(34) FROM nation""",
)
def k3(spark, sf_dir):
    own = _t(spark, sf_dir, "nation")
    name = F.when(F.col("n_regionkey") != 0, F.col("n_name"))
    made = F.to_json(F.struct(F.col("n_nationkey").alias("k"), name.alias("n"), F.concat(F.lit('a,"'), "n_name", F.lit('"')).alias("v")))
    return metadata.csv_rows(own.select(F.col("n_nationkey").alias("row_no"), made.alias("json")))


@query("k4_missing_fields", "SELECT n_nationkey::BIGINT AS row_no, 'n' AS field FROM nation WHERE n_regionkey = 0")
def k4(spark, sf_dir):
    own = _t(spark, sf_dir, "nation")
    made = F.to_json(F.struct(F.col("n_nationkey").alias("k"), F.when(F.col("n_regionkey") != 0, F.col("n_name")).alias("n")))
    return metadata.missing_fields(own.select(F.col("n_nationkey").alias("row_no"), made.alias("json")))


@query("k13_persist_new", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def k13(spark, sf_dir):
    return metadata.new_only(_t(spark, sf_dir, "documents").select("doc_id", "source"), _t(spark, sf_dir, "labels"), "doc_id")


@query("s14_append", "SELECT n_name AS name, n_regionkey AS region FROM nation UNION ALL SELECT r_name, NULL FROM region")
def s14(spark, sf_dir):
    old = _t(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    return metadata.append_all(old, _t(spark, sf_dir, "region").select(F.col("r_name").alias("name")))


@query("w2_last_wins", "SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role FROM conversations GROUP BY conv_id")
def w2(spark, sf_dir):
    return bias.latest(_t(spark, sf_dir, "conversations"), ["conv_id"], "turn").select("conv_id", "turn", "role")


@query("x4_full_pipeline")
def x4(spark, sf_dir):
    own = _docs(spark, sf_dir)
    corpus = _t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    config = pipeline.PipelineConfig(boilerplate_threshold=SHARE, remove_duplicates=True)
    found = pipeline.run(own, config, sample=own, corpus=corpus, lexicon=_lexicon(spark)).records
    return found.select("doc_id", "NumberSentences", "NumberWords", "NumberTokens", "NumberParagraphs", F.size("PersonallyIdentifiableInformation").alias("n_pii"), F.size("BiasedInformation").alias("n_bias"))
