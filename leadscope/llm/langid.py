"""Language identification by compression.

Each language has a zstandard raw-content dictionary: pieces of its texts. A text is compressed with every
dictionary, and the language whose dictionary makes it smallest wins. Where the runner-up comes close (the saving per
byte below ``MARGIN``) the decision is marked as rejected.

Learning reads the texts of a bounded sample (``SAMPLE`` documents a language, the smallest by a hash of their id;
``DICT_BYTES`` of letters a language, ``DOC_BYTES`` of each sampled text, in ``PLACES`` pieces spread evenly over all of it). Every language gets a dictionary;
where there are many, samples and dictionaries are smaller, so that all together stay within ``TOTAL_BYTES``. Prediction reads every whole
text. Only letters count (Unicode's category L: no digits, fractions, superscripts or Roman numeral signs): texts are
lower-cased, everything else becomes one space.

Edge cases: a null text or one without letters gets `und`, score 0, rejected. Ties go to the first language in
alphabetical order, are rejected, and score as a tie. Rows are judged one by one; repeated rows get equal results.
With no learnable row every text gets `und`. An empty table gives no rows. Extra columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, sampled

SAMPLE = 400
DOC_BYTES = 1 << 10
PLACES = 4
DICT_BYTES = 192 << 10
TOTAL_BYTES = 200 * DICT_BYTES
#: Compressors kept in a process; with more languages they are made anew for each ``TEXTS`` texts.
KEPT, TEXTS = 200, 256
PIECE = 32 << 10
MARGIN = 0.004
UNKNOWN = "und"


@lru_cache(maxsize=None)
def _other() -> re.Pattern:
    """Runs of characters that aren't letters: what the re module's words hold besides letters and digits is found by rule."""
    signs = [c for c in range(0x110000) if chr(c).isalnum() and not chr(c).isalpha() and not chr(c).isdecimal()]
    starts = [c for c, before in zip(signs, [-9, *signs]) if c != before + 1]
    ends = [c for c, after in zip(signs, [*signs[1:], -9]) if c != after - 1]
    # ranges: the search tries every member of a class at every character
    return re.compile(r"[\W\d_" + "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends)) + "]+")


def letters(text: str | None) -> bytes:
    """The text's letters in lower case, one space for anything between."""
    if not text:
        return b""
    return _other().sub(" ", text).strip().lower().encode("utf-8", "replace")


def pieces_of(data: bytes, size: int = PIECE) -> list[bytes]:
    """The data cut into as few pieces of equal length (but for a byte) as ``size`` allows."""
    n = max(1, -(-len(data) // size))
    return [data[len(data) * i // n : len(data) * (i + 1) // n] for i in range(n)]


class LanguageModel:
    """Dictionaries by language; compressors are made once per process."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.dictionaries = dict(sorted(dictionaries.items()))
        self._compressors: list | None = None

    def __getstate__(self):
        return {"dictionaries": self.dictionaries, "_compressors": None}

    def compressors(self) -> Iterator:
        """One for each dictionary, in order."""
        def made(content: bytes):
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(dict_data=raw, compression_params=zstandard.ZstdCompressionParameters(**PARAMETERS))

        if len(self.dictionaries) > KEPT:
            return map(made, self.dictionaries.values())
        if self._compressors is None:
            self._compressors = list(map(made, self.dictionaries.values()))
        return iter(self._compressors)

    def sizes(self, texts: list[bytes]) -> np.ndarray:
        """Compressed size by text and language."""
        cut = [pieces_of(data) for data in texts]
        return np.array([[sum(len(c.compress(piece)) for piece in pieces) for pieces in cut] for c in self.compressors()], dtype=np.float64).T

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, rejected."""
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out: list[tuple[str, float, bool]] = []
        names = list(self.dictionaries)
        for at in range(0, len(texts), TEXTS):
            cut = [letters(t) for t in texts[at : at + TEXTS]]
            sizes = iter(self.sizes([data for data in cut if data])) if names and any(cut) else iter(())
            out += [self._decided(names, next(sizes), len(data)) if names and data else (UNKNOWN, 0.0, True) for data in cut]
        return out

    @staticmethod
    def _decided(names: list[str], sizes: np.ndarray, length: int) -> tuple[str, float, bool]:
        order = np.argsort(sizes, kind="stable")
        best = order[0]
        # every saved byte makes the language eight bits likelier; softened, as bytes of one text aren't independent
        score = 1.0 / np.exp2(np.maximum(sizes[best] - sizes, -60.0) * 0.5).sum()
        gap = (sizes[order[1]] - sizes[best]) / length if len(sizes) > 1 else 1.0
        return names[best], float(score), bool(gap < MARGIN)


#: Short matches count: single endings tell languages apart. No frame extras, so that only content is measured.
PARAMETERS = dict(window_log=18, hash_log=17, chain_log=16, search_log=2, min_match=3, strategy=zstandard.STRATEGY_GREEDY,
                  write_checksum=False, write_content_size=False, write_dict_id=False)


def learnable() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1


def fit(documents: DataFrame, sample: int = SAMPLE, dict_bytes: int = DICT_BYTES, total_bytes: int = TOTAL_BYTES) -> LanguageModel:
    """Dictionaries from a bounded sample of the rows that may be learned from.

    ``total_bytes`` bounds the dictionaries together; samples shrink alike.
    """
    prepare(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang").filter(F.col("lang").isNotNull() & learnable())
    languages = max(1, rows.select("lang").distinct().count())
    each = max(1, min(dict_bytes, total_bytes // languages))
    sample = max(1, min(sample, sample * each // dict_bytes + 1))
    doc_bytes = min(DOC_BYTES, each)
    # a text of some length gives pieces that begin at even distances, a short one is a piece by itself
    size = -(-2 * doc_bytes // PLACES)
    begins = F.transform(F.sequence(F.lit(0), F.lit(PLACES - 1)), lambda i: F.floor(i * F.length("text") / PLACES).cast("int"))
    spread = F.transform(begins, lambda b: F.col("text").substr(b + 1, F.lit(size)))
    taken = F.when(F.length("text") > PLACES * size, spread).when(F.col("text").isNotNull(), F.array("text"))
    pieces: dict[str, list[bytes]] = {}
    # at most `sample` rows of 2 * doc_bytes characters a language, by construction
    for r in sampled(rows.select("lang", "doc_id", taken.alias("taken")), "lang", sample).orderBy("lang", "doc_id", "taken").collect():
        pieces.setdefault(r.lang, []).extend(letters(piece)[: doc_bytes // len(r.taken) or 1] for piece in r.taken or [])
    dictionaries = {lang: content[:each] for lang, p in pieces.items() if (content := b" ".join(p)).strip()}
    return LanguageModel(dictionaries)


def predicted(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row."""
    prepare(documents.sparkSession)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(model.predict_all([t if isinstance(t, str) else None for t in batch]), columns=["lang_pred", "score", "rejected"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), predict(F.col("text")).alias("p"))
    return rows.select("doc_id", (~F.coalesce(learnable(), F.lit(True))).alias("held_out"), "p.lang_pred", "p.score", "p.rejected")
