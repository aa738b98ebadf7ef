from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from rideflow.llm import packing

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
LIBRARY = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, source string, text string"
WORDS = ["apple", "river", "stone", "\n", "中文", "x1", "<|endoftext|>"]


def some(n, sources, most=400, seed=1):
    rng = random.Random(seed)
    return [(i, f"s{i % sources}" if i % 9 else None, " ".join(rng.choices(WORDS, k=rng.randrange(most)))) for i in range(n)]


CASES = {
    "plain": some(1500, 5),
    "one large source": some(600, 1) + [(10_000 + i, f"t{i}", "few words") for i in range(40)],
    "a long text": [(5, "a", "q w e " * 100_000), (6, "b", "short"), (7, "a", "Zürich" * 60_000)],
    "repeated rows": [(7, "a", "x y " * 50)] * 300,
    "nulls": [(None, None, None)] * 5 + [(1, None, ""), (None, "a", "b c")],
    "one token": [(1, "a", None)],
    "no rows": [],
}


def ids_of(text):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1], "<u4").tobytes()


@pytest.mark.parametrize("name", CASES)
def test_every_token_is_packed_once_without_padding(spark, name):
    rows = CASES[name]
    got = packing.packed(spark.createDataFrame(rows, SCHEMA), PATH).collect()
    sequences, held = defaultdict(list), defaultdict(list)
    for r in got:
        assert r.length > 0 and len(r.ids) == 4 * r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        held[r.doc_id, r.doc_tokens].append((r.start, bytes(r.ids)))
    assert sorted(sequences) == list(range(len(sequences)))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0
    wanted = defaultdict(list)
    for doc, _, text in rows:
        wanted[doc, len(ids_of(text)) // 4].append(ids_of(text))
    assert held.keys() == wanted.keys()
    for key, texts in wanted.items():
        cut = np.zeros(key[1], np.int64)
        for start, ids in held[key]:
            cut[start : start + len(ids) // 4] += 1
            assert any(t[4 * start : 4 * start + len(ids)] == ids for t in texts)
        assert (cut == len(texts)).all()
        if len(texts) == 1:
            assert b"".join(ids for _, ids in sorted(held[key])) == texts[0]


def test_report_has_the_checksum_of_the_ids(spark):
    docs = spark.createDataFrame(CASES["plain"][:50], SCHEMA)
    texts = {d: ids_of(t) for d, _, t in CASES["plain"]}
    for r in packing.packing_report(docs, PATH).collect():
        assert r.ids_crc32 == zlib.crc32(texts[r.doc_id][4 * r.start : 4 * (r.start + r.length)])


@pytest.mark.parametrize("weights", [None, {f"s{i}": w for i, w in enumerate((5, 1, 2, 2))}])
def test_sequences_hold_the_target_mixture(spark, weights):
    """Up to where the first queue ends, every stretch of sequences is near the target; credit is carried, so it never drifts."""
    rows = [(i, f"s{i % 4}", "w " * (i * 37 % 300)) for i in range(6000)]
    source = {i: s for i, s, _ in rows}
    got = packing.packed(spark.createDataFrame(rows, SCHEMA), PATH, weights).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[source[r.doc_id]] += r.length
    total = sum(sizes.values())
    target = {s: (weights[s] / 10 if weights else n / total) for s, n in sizes.items()}
    until = int(min(n / target[s] for s, n in sizes.items()) / 2048)
    taken = defaultdict(lambda: defaultdict(int))
    for r in got:
        taken[r.sequence_id][source[r.doc_id]] += r.length
    held, worst = defaultdict(int), 0
    for sequence in range(until - packing.SHARD // 2048):
        for s in target:
            held[s] += taken[sequence][s]
            worst = max(worst, abs(held[s] - target[s] * 2048 * (sequence + 1)))
    assert until > 200 and worst <= 4 * packing.QUANTUM


def test_a_source_without_weight_is_an_error(spark):
    with pytest.raises(Exception, match="no weight for source"):
        packing.packed(spark.createDataFrame([(1, "a", "b")], SCHEMA), PATH, {"b": 1.0}).collect()


def test_chunks_encode_alike():
    rng = random.Random(3)
    encoder = packing.Encoder(PATH)
    letters = "ab Z'st\n\t 1,.;é中文。 ßǅʰ١  　😀-"
    for i in range(3000):
        text = "".join(rng.choices(letters, k=rng.randrange(1, 80)))
        text = text if i % 20 else f"{text}<|endoftext|>{text} <|endoftext|>"
        pieces = packing.chunks(text, ["<|endoftext|>"], rng.randrange(1, 9))
        assert "".join(pieces) == text
        wanted = LIBRARY.encode(text, add_special_tokens=False).ids
        assert [i for p in pieces for i in LIBRARY.encode(p, add_special_tokens=False).ids] == wanted
        assert np.frombuffer(next(encoder.ids([text])), encoder.kind).tolist() == [*wanted, 1]


def test_the_rest_is_cut_into_powers_of_two():
    assert packing.sequence_ends(5000) == (2, [4096 + 512, 4096 + 512 + 256, 4096 + 896, 5000])
    assert packing.sequence_ends(4096) == (2, []) and packing.sequence_ends(0) == (0, [])


def test_other_columns_and_keys(spark):
    df = spark.createDataFrame([("k", "a", "x y", 3, "z")], "name string, source string, text string, tokens int, shard string")
    assert {r.name for r in packing.packed(df, PATH, key="name").collect()} == {"k"}


def test_white_space_of_one_text_does_not_meet_that_of_another():
    """Pieces of all texts are encoded together, in any order; none may share a token with its neighbour."""
    edges = ["", " ", "\n", " \n", "\n\n", "\t", "\x0b", "\xa0", "\x1c", "\u3000", " \t \n"]
    texts = [a + word + b for a in edges for word in ("", "river", "中文", "x1 <|endoftext|>") for b in edges]
    encoder = packing.Encoder(PATH)
    for order in (texts, texts[::-1], texts[::2] + texts[1::2]):
        encoder.known = {}
        got = dict(zip(order, encoder.ids(order)))
        wrong = [t for t in texts if np.frombuffer(got[t], encoder.kind).astype("<u4").tobytes() != ids_of(t)]
        assert wrong == []


def test_kept_pieces_are_bounded_and_common_ones_stay(monkeypatch):
    monkeypatch.setattr(packing, "_KNOWN", 50)
    monkeypatch.setattr(packing, "_CHARS", 100)
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    encoder, texts, encoded = packing.Encoder(path), [" the common" + "".join(f" w{n}x{i}" for i in range(8)) for n in range(60)], []
    plain, encode = packing.Encoder(path), encoder._encoded
    monkeypatch.setattr(encoder, "_encoded", lambda pieces: encoded.extend(pieces) or encode(pieces))
    for text, ids in zip(texts, encoder.ids(texts)):
        assert ids == plain._ids(text).tobytes() + plain.end
    assert len(encoder.known) <= 50 and len(encoder.older) <= 50
    assert encoded.count(" common") == 1


def test_words_with_and_without_a_stop_are_encoded_once(monkeypatch):
    """Stops and commas part from the letter before them, whatever surrounds them, and texts keep their order and ids."""
    encoder, encoded = packing.Encoder(PATH), []
    encode = encoder._encoded
    monkeypatch.setattr(encoder, "_encoded", lambda pieces: encoded.extend(pieces) or encode(pieces))
    texts = [" river, river. river\nriver., (river.) river.river", "", "ж, é. x 1,5 3. a.,b \"q.\" .", "a  b, c.\td\x0bd. ", "\0river. \0, x", "a\xa0b, c.", "don't. I'm, 's."]
    for order in (texts, texts[::-1]):
        assert list(encoder.ids(iter(order))) == [np.frombuffer(ids_of(t), "<u4").astype(encoder.kind).tobytes() for t in order]
    assert encoded.count(" river") == 1 and " river," not in encoded and " river." not in encoded


def test_long_pieces_and_groups_of_texts(monkeypatch):
    monkeypatch.setattr(packing, "_CHARS", 40)
    rng, encoder = random.Random(5), packing.Encoder(PATH)
    texts = ["".join(rng.choices("ab. ,\n\xa0é中x'1", k=rng.randrange(90))) for _ in range(500)] + ["ab1é" * 100_000, "x, " * 50_000]
    got = [np.frombuffer(ids, encoder.kind).astype("<u4").tobytes() for ids in encoder.ids(texts)]
    assert got == [ids_of(t) for t in texts]
