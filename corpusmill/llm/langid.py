"""Language identification by compression.

Each language is a Zstandard raw-content dictionary made of labelled excerpts.
A text, reduced to its lower-case letter words, is cut into blocks that cover it
whole, every block is compressed with each dictionary, and the language whose
total is smallest wins. The margin is how much smaller it is than the runner-up,
as a share of the runner-up. Where it is narrow, the whole text is compressed
again in smaller blocks with more effort. Texts of some length whose margin is
then below ``reject_below`` are rejected as ``und``; in a few words a narrow
margin says nothing.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
equal totals go to the language first in alphabetical order with score 0; with no labelled text at all
every text is ``und``; columns of the same name as an output column are
replaced.
"""

from __future__ import annotations

import re

import zstandard
from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from .common import add_columns

UNKNOWN = "und"
#: The bounded sample that a model is fitted on: languages, and of each language texts and characters of a text.
MAX_LANGUAGES, SAMPLE_TEXTS, EXCERPT_CHARS = 256, 400, 240
#: Bytes of a block and effort of the compressor, at first and for texts whose margin is below ``NARROW``.
QUICK, CAREFUL, NARROW = (4096, 3), (1024, 12), 0.06
#: Bytes of letter words from which a text can be rejected for its margin.
ENOUGH = 400
_WORD = re.compile(r"[^\W\d_]+")


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, bytes]:
    """Dictionaries by language, from a sample of bounded size.

    At most ``MAX_LANGUAGES`` languages (the most frequent) with about
    ``SAMPLE_TEXTS`` texts each, chosen by a hash of ``key``, and
    ``EXCERPT_CHARS`` characters of each text. Rows whose language or text is
    null are not used.
    """
    rows = labelled.where(F.col(lang).isNotNull() & (F.length(text) > 0)).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key)).alias("at")
    )
    found = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not found:
        return {}
    share = F.create_map(*[F.lit(v) for r in found for v in (r["lang"], min(1.0, SAMPLE_TEXTS / r["count"]))])
    picked = rows.where((F.pmod("at", F.lit(1 << 20)) / float(1 << 20)) < F.coalesce(share[F.col("lang")], F.lit(0.0)))
    # an excerpt starts at a place that the hash chooses, so that headings do not prevail
    start = F.pmod(F.shiftright("at", 20), F.greatest(F.length("text") - EXCERPT_CHARS + 1, F.lit(1))) + 1
    excerpts = picked.select("lang", "at", F.substring("text", start.cast("int"), F.lit(EXCERPT_CHARS)).alias("text"))
    parts: dict[str, list[str]] = {}
    for row in sorted(excerpts.collect(), key=lambda r: (r["lang"], r["at"], r["text"])):
        parts.setdefault(row["lang"], []).append(row["text"])
    return {k: normal(" ".join(v)) for k, v in sorted(parts.items())}


def normal(text: str) -> bytes:
    """The letter words of a text in lower case, with a space around each."""
    return f" {' '.join(_WORD.findall(text.lower()))} ".encode("utf-8", "replace")


class Classifier:
    def __init__(self, model: dict[str, bytes]):
        self.langs = sorted(model)
        self.steps = []
        for size, level in (QUICK, CAREFUL):
            packers = []
            for lang in self.langs:
                data = zstandard.ZstdCompressionDict(model[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                data.precompute_compress(level=level)
                packers.append(
                    zstandard.ZstdCompressor(
                        level=level, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False
                    ).compress
                )
            self.steps.append((size, packers))

    def predict(self, text: str | None, reject_below: float = 0.0) -> tuple[str, float]:
        """The language and its margin, from 0 to 1."""
        own = normal(text or "")
        if not self.langs or not any(map(str.isalpha, text or "")):  # digits like ½ are no letters
            return UNKNOWN, 0.0
        for size, packers in self.steps:
            blocks = [own[i : i + size] for i in range(0, len(own), size)]
            totals = [sum(map(len, map(pack, blocks))) for pack in packers]
            best = min(totals)
            rest = sorted(totals)[1] if len(totals) > 1 else 2 * best
            margin = (rest - best) / rest
            if margin >= NARROW:
                break
        if margin < reject_below and len(own) >= ENOUGH:
            return UNKNOWN, margin
        return self.langs[totals.index(best)], margin


def classify(
    df: DataFrame,
    model: dict[str, bytes],
    text: str = "text",
    reject_below: float = 0.0,
    out: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """Add the predicted language and its margin; needs no shuffle.

    The model is at most ``MAX_LANGUAGES * SAMPLE_TEXTS * EXCERPT_CHARS``
    characters, so it travels with the task.
    """

    def make():
        classifier = Classifier(model)

        def work(texts):
            found = [classifier.predict(x, reject_below) for x in texts]
            return {out: [k for k, _ in found], score: [float(s) for _, s in found]}

        return work

    return add_columns(df, make, text, **{out: T.StringType(), score: T.DoubleType()})
