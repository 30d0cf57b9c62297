"""Document metadata: 23 fields, parsing, merging, validation and export rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, is_blank, java_trim

# Field names and kinds in the order of the written record.
FIELDS = {
    "Identifier": "string",
    "Licence": "string",
    "PublicationDate": "string",
    "DocumentTitle": "string",
    "Source": "string",
    "Medium": "string",
    "Url": "string",
    "Domain": "array<string>",
    "Keywords": "array<string>",
    "NumberWords": "int",
    "NumberSentences": "int",
    "NumberParagraphs": "int",
    "NumberTokens": "int",
    "PersonallyIdentifiableInformation": "array<double>",
    "BiasedInformation": "array<double>",
    "Author": "array<string>",
    "Style": "string",
    "Type": "string",
    "Subdomain": "array<string>",
    "TranslatedDocument": "boolean",
    "CollectionDate": "string",
    "LicenceLink": "string",
    "TaskCategories": "array<string>",
}
MANDATORY = tuple(list(FIELDS)[:15])
LICENCES = "CC0|CC0-1.0|CC-BY-4.0|CC-BY-SA-4.0|CC-BY-NC-4.0|CC-BY-NC-SA-4.0|Restricted|Proprietary|Unknown".split("|")
MEDIA = ["textual", "multimodal"]
DOMAINS = (
    "Държавно управление|Право и законодателство|Икономика и финанси|Образование|Наука и технологии|Здравеопазване"
    "|Култура и изкуство|Спорт|Медии и журналистика|Общество и политика|Околна среда|Религия|История"
    "|Литература и художествена проза|Неформална комуникация|Друго"
).split("|")
STYLES = "Административен|Журналистически|Научен|Художествен|Разговорен|Правен|Технически|Неформален|".split("|")
KINDS = "Закон|Наредба|Решение|Статия|Книга|Доклад|Интервю|Коментар|Форум|Блог|Уикипедия|Друго|".split("|")
TASKS = (
    "Language Modelling|Text Classification|Named Entity Recognition|Machine Translation|Summarisation|Question Answering"
    "|Sentiment Analysis|Bias Detection|PII Detection|Information Extraction|Coreference Resolution|Dependency Parsing|Other"
).split("|")
# The seed record's defaults that are not the empty string.
SEED_DEFAULTS = {"Medium": "text", "NumberWords": 0, "NumberSentences": 0, "NumberParagraphs": 0, "NumberTokens": 0}

SCHEMA = ", ".join(f"{k} {v}" for k, v in FIELDS.items())


def seed_record(identifier: Column) -> list[Column]:
    """The 23 columns of a seed record; list fields are empty strings there."""
    return [
        (identifier if k == "Identifier" else F.lit(SEED_DEFAULTS.get(k, ""))).alias(k) for k in FIELDS
    ]


def skeleton(identifier: Column) -> list[Column]:
    """The 23 columns of an empty final record."""
    plain = {"string": lambda: F.lit(""), "int": lambda: F.lit(0), "boolean": lambda: F.lit(None).cast("boolean")}
    return [
        (identifier if k == "Identifier" else F.lit("textual") if k == "Medium" else plain[v]() if v in plain else F.array().cast(v)).alias(k)
        for k, v in FIELDS.items()
    ]


def _raw(json: Column, key: str) -> Column:
    """The value of a key as text, trimmed; absent and null give the empty string."""
    return F.coalesce(java_trim(F.get_json_object(json, f"$.{key}")), F.lit(""))


def _list(json: Column, key: str) -> Column:
    raw = F.get_json_object(json, f"$.{key}")
    trimmed = F.coalesce(java_trim(raw), F.lit(""))
    none = F.array().cast("array<string>")
    many = F.filter(F.coalesce(F.from_json(raw, "array<string>"), none), lambda x: x.isNotNull())
    return F.when(trimmed.startswith("["), many).when(is_blank(trimmed), none).otherwise(F.array(trimmed))


def _int(raw: Column) -> Column:
    """An optional sign and digits as an int; anything else, such as 12.0, gives 0."""
    return F.coalesce(F.when(raw.rlike(r"^[+-]?[0-9]+$"), raw.try_cast("int")), F.lit(0))


def parse_record(json: str | Column) -> list[Column]:
    """The 23 typed columns of a metadata JSON object; text trimmed, bad numbers 0, bad list numbers dropped."""
    j = col(json)
    out = []
    for key, kind in FIELDS.items():
        if kind == "string":
            value = _raw(j, key)
        elif kind == "int":
            value = _int(_raw(j, key))
        elif kind == "boolean":
            raw = _raw(j, key)
            value = F.when(is_blank(raw), F.lit(None)).otherwise(F.lower(raw) == "true")
        elif kind == "array<double>":
            value = F.filter(F.transform(F.when(_raw(j, key).startswith("["), _list(j, key)).otherwise(F.array().cast("array<string>")), lambda x: x.try_cast("double")), lambda x: x.isNotNull())
        else:
            value = _list(j, key)
        out.append(value.alias(key))
    return out


def to_json(prefix: str = "") -> Column:
    """The record as JSON: all 23 keys, an unknown translation as the empty string."""
    parts = []
    for key, kind in FIELDS.items():
        c = F.col(f"{prefix}{key}")
        if kind == "boolean":
            c = F.coalesce(c.cast("string"), F.lit(""))
        elif kind.startswith("array"):
            c = F.coalesce(c, F.array().cast(kind))
        parts.append(c.alias(key))
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def merge_legacy(records: DataFrame, legacy: str) -> DataFrame:
    """Fill empty fields from a seed record's JSON; Medium, Keywords, TaskCategories and vectors stay."""
    j = F.col(legacy)
    texts = "Identifier Licence LicenceLink PublicationDate DocumentTitle Source Url Style Type CollectionDate".split()
    out = {k: F.when(is_blank(k), _raw(j, k)).otherwise(F.col(k)) for k in texts}
    for k in ("Author", "Domain", "Subdomain"):
        seed = _raw(j, k)
        out[k] = F.when((F.size(k) == 0) & ~is_blank(seed), F.array(seed)).otherwise(F.col(k))
    for k in ("NumberWords", "NumberSentences", "NumberParagraphs", "NumberTokens"):
        out[k] = F.when(F.col(k) == 0, _int(_raw(j, k))).otherwise(F.col(k))
    translated = _raw(j, "TranslatedDocument")
    out["TranslatedDocument"] = F.coalesce("TranslatedDocument", F.when(~is_blank(translated), F.lower(translated) == "true"))
    return records.withColumns(out)


def load_or_create(stems: DataFrame, files: DataFrame) -> DataFrame:
    """The record of each stem: from ``<stem>_meta.json``, else ``<stem>.json``, else a skeleton.

    ``files`` are (file_name, json). A file that is no JSON object is passed over.
    One that names an Identifier is a full record; others are merged into a
    skeleton as seed records.
    """
    named = files.withColumn("stem", F.regexp_replace("file_name", r"(_meta)?\.json$", "")).withColumn(
        "priority", F.when(F.col("file_name").endswith("_meta.json"), 1).otherwise(2)
    )
    good = named.where(F.from_json("json", "map<string,string>").isNotNull() & F.col("json").rlike(r"^\s*\{"))
    best = good.groupBy("stem").agg(F.min_by("json", "priority").alias("json"))
    joined = stems.select("stem").join(best, "stem", "left")
    full = F.get_json_object("json", "$.Identifier").isNotNull()
    parsed = joined.where(full).select("stem", *parse_record("json"))
    rest = joined.where(~F.coalesce(full, F.lit(False)))
    merged = merge_legacy(rest.select("stem", "json", *skeleton(F.col("stem"))), "json").drop("json")
    return parsed.unionByName(merged)


def missing_mandatory() -> Column:
    """Names of the seven checked fields that are blank or zero."""
    blank = [F.when(is_blank(k), F.lit(k)) for k in ("Identifier", "Licence", "Medium")]
    zero = [F.when(F.col(k) == 0, F.lit(k)) for k in ("NumberWords", "NumberSentences", "NumberParagraphs", "NumberTokens")]
    return F.filter(F.array(*blank, *zero), lambda x: x.isNotNull())


def violations(records: DataFrame, key: str = "Identifier") -> DataFrame:
    """(key, field, rule) for each rule of the record schema that is broken."""
    broken: list[tuple[str, str, Column]] = [("Identifier", "pattern", ~F.col("Identifier").rlike("^bg_"))]
    broken += [(k, "required", F.col(k).isNull()) for k in MANDATORY]
    for k, allowed in (("Licence", LICENCES), ("Medium", MEDIA), ("Style", STYLES), ("Type", KINDS)):
        broken.append((k, "enum", ~F.col(k).isin(allowed)))
    for k in ("PublicationDate", "CollectionDate"):
        broken.append((k, "pattern", ~F.col(k).rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2})?$")))
    for k in ("Url", "LicenceLink"):
        broken.append((k, "format", (F.col(k) != "") & ~F.col(k).rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:[^\s]*$")))
    for k in ("Domain", "Keywords", "Subdomain"):
        broken.append((k, "maxItems", F.size(k) > 6))
    for k, allowed in (("Domain", DOMAINS), ("TaskCategories", TASKS)):
        broken.append((k, "items", F.size(F.array_except(k, F.array(*[F.lit(x) for x in allowed]))) > 0))
    for k in ("NumberWords", "NumberSentences", "NumberParagraphs", "NumberTokens"):
        broken.append((k, "minimum", F.col(k) < 0))
    for k in ("PersonallyIdentifiableInformation", "BiasedInformation"):
        broken.append((k, "range", F.exists(k, lambda x: (x < 0) | (x > 1))))
        broken.append((k, "length", (F.size(k) > 0) & (F.size(k) != F.col("NumberSentences"))))
    found = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(f).alias("field"), F.lit(r).alias("rule"))) for f, r, c in broken])
    return records.select(F.col(key).alias("key"), F.explode(F.filter(found, lambda x: x.isNotNull())).alias("v")).select("key", "v.field", "v.rule")


def unknown_keys(json: str | Column) -> Column:
    """Keys of a JSON object that the record does not have."""
    return F.array_except(F.json_object_keys(col(json)), F.array(*[F.lit(k) for k in FIELDS]))


def csv_value(c: str | Column) -> Column:
    """A CSV field: null is empty; quoted where it holds a comma, a quote or a line feed, quotes doubled."""
    text = F.coalesce(col(c), F.lit(""))
    return F.when(text.rlike('[,"\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def csv_rows(objects: DataFrame, json: str = "json", order: str = "row_no") -> DataFrame:
    """(row_no, value): header with the union of all keys in alphabetical order, then one line for each JSON object.

    Entries that are no object are skipped; without any object there are no rows.
    """
    maps = objects.select(order, F.from_json(json, "map<string,string>").alias("m")).where(F.col("m").isNotNull())
    keys = maps.select(F.explode(F.map_keys("m")).alias("k")).agg(F.array_sort(F.collect_set("k")).alias("keys")).where(F.size("keys") > 0)
    head = keys.select(F.lit(-1).cast("long").alias("row_no"), F.array_join("keys", ",").alias("value"))
    body = maps.crossJoin(F.broadcast(keys)).select(
        F.col(order).cast("long").alias("row_no"),
        F.array_join(F.transform("keys", lambda k: csv_value(F.try_element_at("m", k))), ",").alias("value"),
    )
    return head.unionByName(body)


def missing_fields(objects: DataFrame, json: str = "json", order: str = "row_no") -> DataFrame:
    """(row_no, field) of keys that other objects have and this one has not."""
    maps = objects.select(order, F.from_json(json, "map<string,string>").alias("m")).where(F.col("m").isNotNull())
    keys = maps.select(F.explode(F.map_keys("m")).alias("k")).agg(F.collect_set("k").alias("keys"))
    lacking = maps.crossJoin(F.broadcast(keys)).select(F.col(order).cast("long").alias("row_no"), F.explode(F.array_except("keys", F.map_keys("m"))).alias("field"))
    return lacking


def wrapped(records: DataFrame, order: str) -> DataFrame:
    """One row: all seed records as ``{"metadata": [...]}``, for small exports."""
    packed = records.select(F.struct(F.col(order).alias("o"), F.to_json(F.struct(*FIELDS)).alias("j")).alias("x"))
    return packed.agg(
        F.concat(F.lit('{"metadata":['), F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["j"]), ","), F.lit("]}")).alias("json")
    )


def new_only(batch: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not there yet; what exists is never overwritten."""
    return batch.join(existing.select(key).distinct(), key, "left_anti")


def append_all(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of both, fields that one side lacks null; nothing is deduplicated."""
    return existing.unionByName(batch, allowMissingColumns=True)


def assemble(records: DataFrame, scores: DataFrame, counts: DataFrame, paragraphs: DataFrame, key: str) -> DataFrame:
    """Records with vectors and counts set; documents without sentences are left out.

    ``scores`` are (key, sent_no, pii, bias); vectors are in sentence order, and
    empty where a score was skipped, that is null.
    """
    ordered = F.array_sort(F.collect_list(F.struct("sent_no", "pii", "bias")))
    vectors = scores.groupBy(key).agg(ordered.alias("v")).select(
        key,
        F.filter(F.transform("v", lambda x: x["pii"]), lambda x: x.isNotNull()).alias("PersonallyIdentifiableInformation"),
        F.filter(F.transform("v", lambda x: x["bias"]), lambda x: x.isNotNull()).alias("BiasedInformation"),
    )
    set_here = ["PersonallyIdentifiableInformation", "BiasedInformation", "NumberSentences", "NumberWords", "NumberTokens", "NumberParagraphs"]
    full = records.drop(*set_here).join(vectors, key).join(counts, key).join(paragraphs, key)
    return full.where("NumberSentences > 0").select(key, *FIELDS)
