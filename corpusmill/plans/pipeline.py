"""The whole curation run as a composition of stages."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sentences import Splitter, split_text
from ..operators import bias, clean, counts, dedup, metadata, pii


@dataclass(frozen=True)
class PipelineConfig:
    """Options with their defaults; wrong ones are reported together."""

    boilerplate_threshold: float = 0.50
    dedup_threshold: float = 0.90
    shingle_size: int = 5
    num_hashes: int = 200
    remove_duplicates: bool = False
    keep_backups: bool = True
    skip_cleaning: bool = False
    skip_dedup: bool = False
    skip_pii: bool = False
    skip_bias: bool = False
    sketches: bool = False
    sentences_from: str = "cleaned"
    splitter: Splitter = split_text
    policy: dict = field(default_factory=lambda: dict(pii.POLICY))

    def __post_init__(self):
        wrong = []
        for name in ("boilerplate_threshold", "dedup_threshold"):
            if not 0.0 <= getattr(self, name) <= 1.0:
                wrong.append(f"{name} lies in [0, 1]")
        for name in ("shingle_size", "num_hashes"):
            if getattr(self, name) < 1:
                wrong.append(f"{name} is at least 1")
        if self.sentences_from not in ("cleaned", "raw"):
            wrong.append("sentences_from is 'cleaned' or 'raw'")
        if wrong:
            raise ValueError("; ".join(wrong))


@dataclass
class PipelineResult:
    docs: DataFrame
    sentences: DataFrame
    records: DataFrame
    pairs: DataFrame | None
    blocklist: DataFrame | None
    errors: DataFrame
    backups: DataFrame | None


def run(
    docs: DataFrame,
    config: PipelineConfig | None = None,
    sample: DataFrame | None = None,
    corpus: DataFrame | None = None,
    seeds: DataFrame | None = None,
    lexicon: DataFrame | None = None,
) -> PipelineResult:
    """Clean, deduplicate, split, score and count (doc_id, text).

    The corpus and the lexicon are read at once, to see whether workers can hold them; all else runs when results are used.

    ``sample`` is what boilerplate is learned from, and needed unless cleaning is
    skipped. Without ``corpus`` there is no deduplication; without ``lexicon`` no
    bias. ``seeds`` are (stem, json). Documents that deduplication empties get no
    record; documents without sentences are errors.
    """
    config = config or PipelineConfig()
    if not config.skip_cleaning and sample is None:
        raise ValueError("cleaning needs a sample of documents")
    raw, blocklist, pairs = docs.select("doc_id", "text"), None, None
    current = raw
    if not config.skip_cleaning:
        blocklist = clean.learn_blocklist(sample, config.boilerplate_threshold)
        current = clean.clean(current, blocklist).select("doc_id", "text")
        if not config.skip_dedup and corpus is not None:
            # read for matches, for lines and for documents
            current = current.persist(StorageLevel.DISK_ONLY)
    if not config.skip_dedup and corpus is not None:
        new = dedup.corpus_lines(current, "doc_id", size=config.shingle_size)
        old = dedup.corpus_lines(corpus, "doc_id", size=config.shingle_size)
        if config.sketches:
            similar = dedup.similar_sketches(new, old, config.dedup_threshold, config.shingle_size, config.num_hashes)
        else:
            similar = dedup.similar_texts(new, old, config.dedup_threshold, config.shingle_size)
        pairs = dedup.duplicate_pairs(new, old, similar)
        if config.remove_duplicates:
            gone = dedup.flagged(new, similar).select(F.col("file").alias("doc_id"), "line_no")
            current = dedup.remove_flagged(current, gone, size=config.shingle_size).select("doc_id", "text").persist(StorageLevel.DISK_ONLY)
    source = raw.join(current.select("doc_id"), "doc_id", "left_semi") if config.sentences_from == "raw" else current
    # several stages read the sentences; stored blocks are computed again if an executor is lost
    split = counts.split_documents(source, splitter=config.splitter).persist(StorageLevel.DISK_ONLY)
    sentences = counts.rows_of(split)
    # scores are columns added in place, so that sentences are not joined to themselves
    scored = sentences
    if not config.skip_pii:
        found = pii.score_sentences(scored, policy=config.policy)
        scored = found.select("doc_id", "sent_no", "sentence", F.col("piiCoverage").alias("pii"))
    else:
        scored = scored.withColumn("pii", F.lit(None).cast("double"))
    if not config.skip_bias and lexicon is not None:
        named = scored.withColumn("sid", F.struct("doc_id", "sent_no"))
        found = bias.score_sentences(named, bias.form_index(lexicon), "sid")
        scored = found.select("doc_id", "sent_no", "pii", F.col("totalCoverage").alias("bias"))
    else:
        scored = scored.select("doc_id", "sent_no", "pii", F.lit(None).cast("double").alias("bias"))
    stems = current.select(F.col("doc_id").cast("string").alias("stem"))
    files = seeds if seeds is not None else stems.sparkSession.createDataFrame([], "file_name string, json string")
    records = metadata.load_or_create(stems, files)
    tally = counts.counts_of(split)
    full = metadata.assemble(
        records.withColumnRenamed("stem", "doc_id"),
        scored.withColumn("doc_id", F.col("doc_id").cast("string")),
        tally.withColumn("doc_id", F.col("doc_id").cast("string")),
        counts.paragraph_counts(current).withColumn("doc_id", F.col("doc_id").cast("string")),
        "doc_id",
    )
    return PipelineResult(
        current, sentences, full, pairs, blocklist, tally.where("NumberSentences = 0"), raw if config.keep_backups else None
    )
