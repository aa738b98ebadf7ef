"""Token counts of whole texts, also of huge ones: overlapping chunks, spliced where they agree.

A text of more than a chunk is encoded in overlapping chunks. Two neighbours are spliced at a
position of their overlap where both have a token boundary and where no token can ever cross: the
start of a run of spaces after another character. That holds because no piece of the vocabulary
has a space mark behind another character, which is checked when the model is loaded. If an
overlap holds no such position it is widened, in the end to the whole chunk, which then grows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from rideflow.llm.common import fresh, small_batches, whole_text

#: Characters of a chunk and of an overlap to begin with. A worker holds the tokens of one chunk.
CHUNK, OVERLAP = 1 << 16, 256
LIMIT = 4096
_SPACE = "▁"


def _is_byte(piece: str) -> bool:
    return len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">")


def _characters(piece: str) -> int:
    """How many characters of the text a piece stands for; of a character's bytes only the first counts."""
    if _is_byte(piece):
        return 0 if 0x80 <= int(piece[3:5], 16) < 0xC0 else 1
    return len(piece)


class Tokens:
    """Counts the tokens of texts with one model."""

    def __init__(self, model: bytes, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.encode = sentencepiece.SentencePieceProcessor(model_proto=model).encode
        self.chunk, self.overlap = chunk, overlap
        known = sentencepiece_model_pb2.ModelProto()
        known.ParseFromString(model)
        plain = not known.normalizer_spec.precompiled_charsmap and not known.normalizer_spec.remove_extra_whitespaces
        whole = all(_SPACE not in p.piece.lstrip(_SPACE) for p in known.pieces)
        self.spaces_part = plain and whole and not known.trainer_spec.treat_whitespace_as_suffix

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text, as its whole encoding has."""
        huge = {i for i, t in enumerate(texts) if self.spaces_part and len(t) > self.chunk + self.overlap}
        short = iter(self.encode([t for i, t in enumerate(texts) if i not in huge], num_threads=1))
        return [self.spliced(t) if i in huge else len(next(short)) for i, t in enumerate(texts)]

    def _starts(self, text: str, start: int, end: int) -> list[int]:
        """Where the tokens of a part of the text start; a space mark put before it stands at ``start``."""
        pieces = self.encode(text[start:end], out_type=str)
        starts, at = [], end
        for piece in reversed(pieces):
            at -= _characters(piece)
            starts.append(max(at, start))
        starts.reverse()
        return starts

    @staticmethod
    def _parts(text: str, at: int) -> bool:
        return text[at] == " " and text[at - 1] not in (" ", _SPACE)

    def spliced(self, text: str) -> int:
        """The number of tokens of a huge text."""
        total, begin = 0, 0  # the tokens before ``begin`` are counted
        start, end = 0, min(len(text), self.chunk)
        left = self._starts(text, start, end)
        while end < len(text):
            width = self.overlap
            while True:
                lo = max(start, end - width)
                hi = min(len(text), lo + max(self.chunk, 2 * width))
                right = self._starts(text, lo, hi)
                common = set(right)
                # From the right: tokens at the very end may change with what follows.
                cut = next((p for p in reversed(left) if lo < p < end and p > begin and p in common and self._parts(text, p)), None)
                if cut is not None or lo == start:
                    break
                width *= 2
            if cut is None:  # nothing to splice at in the whole chunk: it grows
                left, end = right, hi
                continue
            total += sum(begin <= p < cut for p in left)
            begin, start, end, left = cut, lo, hi, right
        return total + sum(p >= begin for p in left)


def counted(docs: DataFrame, model_file: str, limit: int = LIMIT) -> DataFrame:
    """The rows with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    Null and empty texts have none. Begin, end and special tokens are not added, and their strings
    in a text are ordinary text. Columns of these names in ``docs`` stay; the new ones then get
    longer names.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(model_file, "rb") as file:  # half a megabyte, read by the driver and sent along
        shared = spark.sparkContext.broadcast(file.read())

    @F.pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = Tokens(shared.value)
        for texts in parts:
            yield pd.Series(tokens.count(list(texts)), dtype="int64")

    n_bytes, n_tokens, over = (fresh(docs, n) for n in ("n_bytes", "n_tokens", "over_limit"))
    rows = docs.withColumns({n_bytes: F.octet_length(whole_text()).cast("long"), n_tokens: count(whole_text())})
    return rows.withColumn(over, F.col(n_tokens) > limit)


def token_report(docs: DataFrame, model_file: str) -> DataFrame:
    """One row per document: bytes, tokens, and whether they exceed the limit."""
    rows = counted(docs.select("doc_id", "text"), model_file)
    return rows.drop("text")
