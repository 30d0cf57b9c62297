"""CoNLL-UP corpora: comments ``# key = value`` and token lines with tabs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import java_lines, java_trim, split_tabs
from ..operators.metadata import seed_record
from .base import read_files

#: Token lines have more columns than this; the part of speech is in the column of this index.
COLUMNS, POS_COLUMN = 5, 3


@dataclass(frozen=True)
class ConllUpFormat:
    """Comment keys by metadata field, and constant fields."""

    prefix: str
    keys: dict[str, str]
    constants: dict[str, str] = field(default_factory=dict)


# The two corpora that are known.
MARCELL = ConllUpFormat(
    "bg_MARCELL_",
    {"date": "PublicationDate", "title": "DocumentTitle", "issuer": "Author", "type": "Type", "url": "Url"},
    {
        "Licence": "CC0-1.0",
        "LicenceLink": "https://elrc-share.eu/static/metashare/licences/CC0-1.0.pdf",
        "Domain": "Държавно управление",
        "Style": "Административен",
    },
)
CURLICAT = ConllUpFormat(
    "bg_CURLICAT_",
    {k: k for k in "PublicationDate DocumentTitle Author".split()}
    | {"DocumentType": "Type"}
    | {k: k for k in "Url Style Domain Subdomain CollectionDate".split()}
    | {"License": "Licence"},
    {"Licence": "CC-BY-SA-4.0", "LicenceLink": "https://elrc-share.eu/static/metashare/licences/CC-BY-SA-4.0.pdf"},
)


def conll_lines(files: DataFrame) -> DataFrame:
    """(file_name, line_no, line)."""
    return files.select("file_name", F.posexplode(java_lines("text")).alias("line_no", "line"))


def comment_value(line: str, key: str) -> Column:
    """What follows ``# key =``; every occurrence of that prefix is removed, and the rest trimmed."""
    return java_trim(F.replace(F.col(line), F.lit(f"# {key} ="), F.lit("")))


def is_comment(key: str, line: str = "line") -> Column:
    return F.col(line).startswith(f"# {key} =")


def structure(lines: DataFrame, form: ConllUpFormat) -> DataFrame:
    """One row for each file: comments (the last one wins), text, and counts, in one aggregation."""
    known = F.lit(False)
    for key in [*form.keys, "sent_id", "newpar id", "text"]:
        known = known | is_comment(key)
    columns = split_tabs("line")
    token = ~known & (F.size(columns) > COLUMNS)
    piece = F.when(is_comment("newpar id"), F.lit("\n")).when(is_comment("text"), F.concat(comment_value("line", "text"), F.lit("\n")))
    values = [
        F.max_by(F.when(is_comment(key), comment_value("line", key)), F.when(is_comment(key), F.col("line_no"))).alias(name)
        for key, name in form.keys.items()
    ]
    return lines.groupBy("file_name").agg(
        *values,
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(piece.isNotNull(), F.struct("line_no", piece.alias("p"))))), lambda x: x["p"]), "").alias("text"),
        F.count_if(is_comment("sent_id")).cast("int").alias("NumberSentences"),
        F.count_if(is_comment("newpar id")).cast("int").alias("NumberParagraphs"),
        F.count_if(token).cast("int").alias("NumberTokens"),
        F.count_if(token & (F.get(columns, F.lit(POS_COLUMN)) != "PUNCT")).cast("int").alias("NumberWords"),
    )


def extract_files(files: DataFrame, form: ConllUpFormat) -> tuple[DataFrame, DataFrame]:
    """Documents and seed records of (file_name, text); files without a line are empty documents."""
    found = files.select("file_name").join(structure(conll_lines(files), form), "file_name", "left")
    doc_id = F.concat(F.lit(form.prefix), F.replace("file_name", F.lit(".conllup"), F.lit("")))
    named = found.withColumn("doc_id", doc_id)
    docs = named.select("doc_id", "file_name", F.coalesce("text", F.lit("")).alias("text"))
    values = {name: F.col(name) for name in form.keys.values()}
    values |= {k: F.col(k) for k in ("NumberWords", "NumberSentences", "NumberParagraphs", "NumberTokens")}
    seed = []
    for c, name in zip(seed_record(F.col("doc_id")), _names()):
        fixed = F.lit(form.constants[name]) if name in form.constants else c
        seed.append(F.coalesce(values[name], fixed).alias(name) if name in values else fixed.alias(name))
    return docs, named.select(*seed)


def _names() -> list[str]:
    from ..operators.metadata import FIELDS

    return list(FIELDS)


@dataclass(frozen=True)
class ConllUpSource:
    """All files of a folder, whatever their extension."""

    form: ConllUpFormat

    def extract(self, spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
        return extract_files(read_files(spark, path), self.form)
