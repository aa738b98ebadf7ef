"""Mixture-controlled packing: deficit round-robin over one queue of tokens per source.

Every source has a rate, its part of the target mixture. The tokens of its queue, in blocks of
``QUANTUM``, fall due at that rate, and all that falls due within the same ``SHARD`` tokens of the mix
is one shard: what a block's rounding takes from a source in one shard is paid in a later one. A shard is
one task's work: it fills sequence after sequence; each credits all sources by their part, and they
take turns to spend their credit, whose rest goes on to the next sequence. A shard starts where the ones
before it end, so sequences have no padding between shards either.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rideflow.llm.common import BATCH_ROWS, small_batches, whole_text, written
from rideflow.operators.lookup import lookup_join

#: Tokens of a sequence, and the token that ends a document.
SEQUENCE, END = 2048, 1
#: A turn is worth waiting for from so many tokens of credit; sources are dealt to shards in such blocks.
QUANTUM = 512
#: Tokens that fall due in one shard.
SHARD = 64 * SEQUENCE
#: Characters of texts parted into pieces together, and those handed to the tokenizer at once, from which a piece is cut.
_CHARS, _LONG = 1 << 20, 1 << 18
#: Pieces of text whose ids a task keeps at most twice, in a new and an old set, and the length up to which it does.
_KNOWN, _SHORT = 400_000, 64
#: So many of them are encoded at once.
_TOGETHER = 10_000
#: White space and the word after it. Words part before white space, so pieces can be encoded one by one.
_PIECE = r"([ \t\n\r\f\v]*[^ \t\n\r\f\v]+|[ \t\n\r\f\v]+)"
_SPACES = (" ", "\t", "\n", "\r", "\f", "\v")
#: More than one blank or line break in a row, and other white space of these.
_WIDE_SPACE = r"[ \n][ \n]|[\t\r\f\v]"
#: Other white space, which tokens may span together with the above, and the mark that parts pieces.
_ODD_SPACE = r"[\x00\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: A Latin, Greek or Cyrillic letter and the stop or comma after it, which no token spans: words with and without it share their ids.
_STOP = r"([A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}\x{3b1}-\x{3c9}\x{400}-\x{481}])([.,])"
#: Where no token crosses: before white space, and after the last letter of a word.
_CUT = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=\P{L})")
_TOKENS = pa.schema([("doc_id", pa.string()), ("tree", pa.string()), ("part", pa.int64()), ("before", pa.int64()), ("tokens", pa.int64()), ("ids", pa.binary())])
_PIECES = pa.schema([
    ("doc_id", pa.string()), ("doc_tokens", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
])


@lru_cache(1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def id_width(path: str) -> int:
    """Bytes that hold any id of the vocabulary."""
    return 2 if max(_tokenizer(path).get_vocab().values()) < 1 << 16 else 4


def chunks(text: str, added: Sequence[str] = (), size: int = _LONG) -> list[str]:
    """The text in pieces of about the size, cut only where the byte-level pre-tokenizer always parts words.

    White space never belongs to the token before it, and what follows a letter and is none never to
    that letter's token. ``added`` tokens are not cut. A stretch without such a place stays whole.
    """
    out, start = [], 0
    for cut in _CUT.finditer(text, size):
        at = cut.start()
        if at - start >= size and not any(text.find(t, max(start, at - len(t) + 1), at + len(t) - 1) >= 0 for t in added):
            out.append(text[start:at])
            start = at
    out.append(text[start:])
    return out


class Encoder:
    """The library's ids of whole texts and the end token, as bytes.

    Texts are parted by Arrow into pieces between white space; each different one of a group is looked up, and short ones
    are encoded once and kept.
    """

    def __init__(self, path: str, end: int = END):
        self.tokenizer, self.kind = _tokenizer(path), f"<u{id_width(path)}"
        self.end = np.array([end], self.kind).tobytes()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.stops_part = not any("." in t or "," in t for t in self.added)
        vocabulary = self.tokenizer.get_vocab()
        # A letter of a byte-level token stands for one byte.
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.bytes_of[list(vocabulary.values())] = [len(t) for t in vocabulary]
        # The pieces of late, and those of before: what is met again moves over, the rest goes when the new set is full.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        """The ids of the pieces. Those that start, and do not end, with white space are encoded together and parted by the bytes they cover.

        White space at the end of one and at the start of the next would make one token of both.
        """
        out: list[bytes] = [b""] * len(pieces)
        spaced, plain = [], []
        for place, p in enumerate(pieces):
            (spaced if p[:1] in _SPACES and not p[-1:].isspace() else plain).append(place)
        for place, found in zip(plain, self.tokenizer.encode_batch_fast([pieces[i] for i in plain], add_special_tokens=False)):
            out[place] = np.array(found.ids, self.kind).tobytes()
        for start in range(0, len(spaced), _TOGETHER):
            places = spaced[start : start + _TOGETHER]
            held = [pieces[i] for i in places]
            ids = self._ids("".join(held))
            covered = np.cumsum(pc.binary_length(pa.array(held, pa.string())).to_numpy())
            ends = ((np.searchsorted(np.cumsum(self.bytes_of[ids]), covered) + 1) * ids.itemsize).tolist()
            data = ids.tobytes()
            for place, i, j in zip(places, [0, *ends], ends):
                out[place] = data[i:j]
        return out

    def _long(self, text: str) -> bytes:
        """The ids of a text that is not kept, a bounded number of characters at a time."""
        return b"".join(self._ids(c).tobytes() for c in (chunks(text, self.added) if len(text) > _LONG else (text,)))

    def _parted(self, texts: pa.Array) -> pa.Array:
        """The texts as lists of pieces that can be encoded one by one; none holds odd white space."""
        if self.stops_part:
            texts = pc.replace_substring_regex(texts, _STOP, "\\1\0\\2")
        wide = pc.match_substring_regex(texts, _WIDE_SPACE).to_numpy(zero_copy_only=False)
        order = np.argsort(wide, kind="stable")
        narrow, rest = (texts.take(pa.array(places)) for places in np.split(order, [np.count_nonzero(~wide)]))
        # The same cuts before single blanks and line breaks, at less cost.
        narrow = pc.replace_substring(pc.replace_substring(narrow, " ", "\0 "), "\n", "\0\n")
        rest = pc.replace_substring_regex(rest, _PIECE, "\0\\1")
        return pc.split_pattern(pa.concat_arrays([narrow, rest]).take(pa.array(np.argsort(order))), "\0")

    def ids(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text and the end token; a bounded number of characters, or one text, at a time."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size > _CHARS:
                yield from self._some(held)
                held, size = [], 0
        if held:
            yield from self._some(held)

    def _some(self, texts: list[str]) -> Iterator[bytes]:
        column = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(column, _ODD_SPACE)
        parted = self._parted(column.filter(pc.invert(odd)))
        pieces = parted.flatten().dictionary_encode()
        ids = pa.array(self._found(pieces.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary()).take(pieces.indices)
        # The pieces' ids lie behind each other, so those of a text are one stretch.
        _, starts, data = ids.buffers()
        ends = np.frombuffer(starts, np.int64)[parted.offsets.to_numpy()].tolist() if len(ids) else []
        data, stretches = data.to_pybytes() if data else b"", zip(ends, ends[1:])
        for text, whole in zip(texts, odd.to_pylist()):
            if whole:
                yield self._long(text) + self.end
                continue
            start, end = next(stretches)
            yield data[start:end] + self.end

    def _found(self, pieces: list[str]) -> list[bytes]:
        """The ids of different pieces, the kept ones or new."""
        if len(self.known) + len(pieces) > _KNOWN:
            self.known, self.older = {}, self.known
        found, older = list(map(self.known.get, pieces)), self.older.get
        new: list[int] = []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            found[i] = ids = older(pieces[i])
            if ids is not None:
                self.known[pieces[i]] = ids
            elif len(pieces[i]) <= _SHORT:
                new.append(i)
            else:
                found[i] = self._long(pieces[i])
        names = [pieces[i] for i in new]
        made = self._encoded(names)
        self.known.update(zip(names, made))
        for i, ids in zip(new, made):
            found[i] = ids
        return found


@lru_cache(1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def token_table(docs: DataFrame, tokenizer: str, key: str = "doc_id") -> DataFrame:
    """``doc_id, tree, part, before, tokens, ids``: the ids of each document, written once in ``id_width`` bytes each.

    ``tree`` is the source with an ``s`` before it, empty for null. ``part`` is the task that read the row
    and ``before`` the tokens of the same source that the task read earlier.
    """

    width = id_width(tokenizer)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, queued, encoder = TaskContext.get().partitionId(), {}, _encoder(tokenizer)
        waiting: deque[tuple] = deque()

        def texts() -> Iterator[str]:
            for batch in batches:
                for doc, tree, text in zip(*(column.to_pylist() for column in batch.columns)):
                    waiting.append((doc, tree))
                    yield text

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TOKENS.types)], schema=_TOKENS)

        rows: list[tuple] = []
        for ids in encoder.ids(texts()):
            doc, tree = waiting.popleft()
            before, count = queued.get(tree, 0), len(ids) // width
            queued[tree] = before + count
            rows.append((doc, tree, part, before, count, ids))
            if len(rows) == BATCH_ROWS:
                yield made(rows)
                rows = []
        if rows:
            yield made(rows)

    small_batches(docs.sparkSession)
    source = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").cast("string").alias("doc_id"), source.alias("tree"), whole_text().alias("text"))
    return written(rows.mapInArrow(read, "doc_id string, tree string, part long, before long, tokens long, ids binary"), "tokens")


def _queues(tokens: DataFrame, weights: Mapping[str | None, float] | None) -> tuple[DataFrame, int]:
    """``tree, part, shift, rate``: where each task's tokens lie in their queue and how many of it fall due in a shard; and all tokens."""
    parts = tokens.groupBy("tree", "part").agg(F.max(F.col("before") + F.col("tokens")).alias("held"))
    ahead = F.sum("held").over(Window.partitionBy("tree").orderBy("part")) - F.col("held")
    parts = written(parts.select("tree", "part", "held", ahead.alias("shift")), "queues")
    sizes = parts.groupBy("tree").agg(F.sum("held").alias("size"))
    weight = F.col("size").cast("double")
    if weights is not None:
        given = F.map_from_entries(F.array(*[F.struct(F.lit("" if s is None else f"s{s}"), F.lit(float(w))) for s, w in weights.items()]))
        weight = F.coalesce(F.try_element_at(given, F.col("tree")), F.lit(0.0))
        weight = F.when(weight > 0, weight).otherwise(F.raise_error(F.concat(F.lit("no weight for source "), F.col("tree"))))
    found = sizes.withColumn("weight", weight)
    total = found.agg(F.sum("weight").alias("weight"), F.sum("size").alias("size")).first()
    rates = found.select(F.col("tree").alias("_tree"), (F.col("weight") / F.lit(total["weight"]).cast("double") * SHARD).alias("rate"))
    # A queue has a row per task; only its own tasks' order is windowed.
    return written(parts.join(rates, F.col("tree") == F.col("_tree")).select("tree", "part", "shift", "rate"), "rates"), total["size"] or 0


def _dealt(tokens: DataFrame, queues: DataFrame, width: int) -> DataFrame:
    """``shard, tree, place, doc_id, doc_tokens, start, length, ids``: each document cut where its blocks fall due in different shards."""
    rows = lookup_join(tokens, queues, {"tree": "tree", "part": "part"}).withColumn("_at", F.col("shift") + F.col("before"))
    end, last = F.col("_at") + F.col("tokens"), F.floor((F.col("_at") + F.col("tokens") - 1) / QUANTUM)
    first = F.floor(F.col("_at") / QUANTUM)

    def shard(block: Column) -> Column:
        """The shard in which the middle of a block falls due."""
        return F.floor((block + 0.5) * QUANTUM / F.col("rate"))

    later = F.when(last > first, F.sequence(first + 1, last)).otherwise(F.array().cast("array<bigint>"))
    cuts = F.transform(F.filter(later, lambda block: shard(block) != shard(block - 1)), lambda block: block * QUANTUM)
    rows = rows.withColumns({"_from": F.concat(F.array("_at"), cuts), "_to": F.concat(cuts, F.array(end))})
    pieces = F.transform(
        F.arrays_zip("_from", "_to"),
        lambda p: F.struct(
            shard(F.floor(p["_from"] / QUANTUM)).alias("shard"), p["_from"].alias("place"), (p["_from"] - F.col("_at")).alias("start"),
            (p["_to"] - p["_from"]).alias("length"),
            F.substring(F.col("ids"), ((p["_from"] - F.col("_at")) * width + 1).cast("int"), ((p["_to"] - p["_from"]) * width).cast("int")).alias("ids"),
        ),
    )
    return rows.select("tree", "doc_id", F.col("tokens").alias("doc_tokens"), F.inline(pieces))


def _begins(dealt: DataFrame) -> DataFrame:
    """``shard, begin``: the tokens in all shards before; sums of blocks of shards, then within a block."""
    sizes = written(dealt.groupBy("shard").agg(F.sum("length").alias("size")), "shards").withColumn("block", F.floor(F.col("shard") / 4096))
    blocks = sizes.groupBy("block").agg(F.sum("size").alias("held"))
    blocks = blocks.select(F.col("block").alias("_block"), (F.sum("held").over(Window.orderBy("block")) - F.col("held")).alias("ahead"))
    inner = F.sum("size").over(Window.partitionBy("block").orderBy("shard")) - F.col("size")
    return written(sizes.join(blocks, F.col("block") == F.col("_block")).select("shard", (inner + F.col("ahead")).alias("begin")), "begins")


def sequence_ends(total: int) -> tuple[int, list[int]]:
    """The number of whole sequences, and where the last ones end: the rest is cut into powers of two, which need no padding."""
    whole, rest = divmod(total, SEQUENCE)
    ends, at = [], whole * SEQUENCE
    for bit in range(SEQUENCE.bit_length() - 2, -1, -1):
        if rest >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return whole, ends


class _Queue:
    """The pieces of one source in a shard, from its head on."""

    def __init__(self, rows: list[tuple]):
        self.rows, self.number, self.used = rows, 0, 0
        self.left = sum(row[3] for row in rows)

    def head(self) -> int:
        """Tokens left of the document at the head."""
        return self.rows[self.number][3] - self.used if self.left else 0

    def take(self, count: int) -> tuple:
        """So many tokens of the head: document, its tokens, start in it, length, ids."""
        doc, doc_tokens, start, length, ids = self.rows[self.number]
        piece = doc, doc_tokens, start + self.used, count, ids[4 * self.used : 4 * (self.used + count)]
        self.used, self.left = self.used + count, self.left - count
        if self.used == length:
            self.number, self.used = self.number + 1, 0
        return piece


def round_robin(queues: list[_Queue], begin: int, total: int) -> Iterator[tuple]:
    """The pieces of a shard with ``sequence_id`` and ``offset``, in order.

    Each sequence credits every source with its part of the room. In turn a source spends what it
    has, a document cut where its credit or the sequence ends; a source with less credit than a
    quantum, and less than its document needs, waits. If all wait, the one with most credit borrows a quantum.
    """
    whole, ends = sequence_ends(total)
    turn, at, left = 0, begin, sum(q.left for q in queues)
    share, credit = [q.left / left for q in queues], [0.0] * len(queues)
    while left:
        number = at // SEQUENCE
        if number < whole:
            first, last = number * SEQUENCE, (number + 1) * SEQUENCE
        else:
            last = next(e for e in ends if e > at)
            number += ends.index(last)
            first = ends[ends.index(last) - 1] if last != ends[0] else whole * SEQUENCE
        room = min(last - at, left)
        credit = [c + s * room for c, s in zip(credit, share)]
        piece, pieces = None, []
        while room:
            waiting = True
            for _ in range(len(queues)):
                queue = queues[turn]
                while room and queue.left and credit[turn] >= min(QUANTUM, queue.head()):
                    pieces.append(queue.take(min(room, queue.head(), int(credit[turn]))))
                    credit[turn] -= pieces[-1][3]
                    room -= pieces[-1][3]
                    waiting = False
                if not room:
                    break
                turn = (turn + 1) % len(queues)
            if waiting:
                most = max((i for i, q in enumerate(queues) if q.left), key=lambda i: credit[i])
                pieces.append(queues[most].take(min(room, queues[most].head(), QUANTUM)))
                credit[most] -= pieces[-1][3]
                room -= pieces[-1][3]
        for new in pieces:
            if piece and piece[0] == new[0] and piece[2] + piece[3] == new[2]:
                piece = (*piece[:3], piece[3] + new[3], piece[4] + new[4])
                continue
            if piece:
                yield *piece, number, at - first
                at, left = at + piece[3], left - piece[3]
            piece = new
        yield *piece, number, at - first
        at, left = at + piece[3], left - piece[3]


def packed(docs: DataFrame, tokenizer: str, weights: Mapping[str | None, float] | None = None, key: str = "doc_id") -> DataFrame:
    """``doc_id, start, length, doc_tokens, sequence_id, offset, ids``: one row per piece of a document in a sequence.

    ``ids`` are the piece's tokens in little-endian 32 bits; ``tokenizer`` is the path of a byte-level
    vocabulary. Every sequence but the last few is full; those are powers of two. ``weights`` are the
    target parts of all sources and above 0; a source that is used up leaves its part to the others. Without weights the
    target is the sources' own part of all tokens, which ends all queues together.

    A null or empty text is its end token alone; null is a source of its own; repeated rows are
    packed each. Without documents there is no row.
    """
    tokens, width = token_table(docs, tokenizer, key), id_width(tokenizer)
    queues, total = _queues(tokens, weights)
    begins = _begins(_dealt(tokens.drop("ids").withColumn("ids", F.lit(None).cast("binary")), queues, width))

    def fill(rows: pa.Table) -> pa.Table:
        _encoder.cache_clear()  # a worker that has made tokens needs its pieces no more
        columns = [rows.column(c).to_pylist() for c in ("tree", "place", "doc_id", "doc_tokens", "start", "length", "ids")]
        held: dict[str, list[tuple]] = {}
        for tree, place, doc, doc_tokens, start, length, ids in sorted(zip(*columns), key=lambda r: r[:2]):
            # A document is told by its place in the queue, since ids may repeat.
            held.setdefault(tree, []).append(((doc, tree, place - start), doc_tokens, start, length, np.frombuffer(ids, f"<u{width}").astype("<u4").tobytes()))
        out: list[list] = [[] for _ in _PIECES]
        for doc, doc_tokens, start, length, ids, number, at in round_robin([_Queue(q) for q in held.values()], rows.column("begin")[0].as_py(), total):
            for column, value in zip(out, (doc[0], doc_tokens, start, length, ids, number, at)):
                column.append(value)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, _PIECES.types)], schema=_PIECES)

    shards = _dealt(tokens, queues, width).join(begins, "shard")
    out = shards.groupBy("shard").applyInArrow(fill, "doc_id string, doc_tokens long, start long, length long, ids binary, sequence_id long, offset long")
    kind = docs.schema[key].dataType
    return out.select(F.col("doc_id").cast(kind).alias(key), "start", "length", "doc_tokens", "sequence_id", "offset", "ids")


def packing_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece, with the CRC-32 of its ids."""
    rows = packed(docs.select("doc_id", "source", "text"), tokenizer)
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
