import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from opsledger.llm import bpe, bpe_codec, queries, token_counts, training_order

BYTE, WORD = queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("word_bpe_49k.json")


def strings():
    rng = random.Random(1)
    letters = "ab '\n \t.1Éß　s\x1cS,  <| 日ΣΟ"
    return ["", " ", "a  b", "a   b", " a", "a ", "a\n b", "a \n b", "a\n \n b", "x<|endoftext|> y", "<|ENDOFTEXT|>a", "ΣΑΣ ΟΔΟΣ",
            "it's we'll 'S I'M", "½ ² ٣ 123", "😀👍🏽", "\x00\x01", "<|startoftext|>Hi<|endoftext|>", "é İ", "ab" * 5000,
            *("".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(1500))]


def test_same_tokens_as_the_library():
    byte, word = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
    count, encode, codec = bpe.PieceCounter(BYTE).of, bpe.ByteEncoder(BYTE).of, bpe.WordCodec(WORD)
    for s in strings():
        wanted = byte.encode(s, add_special_tokens=False).ids
        assert count(s) == len(wanted) and np.frombuffer(encode(s), "<u2").tolist() == wanted, repr(s)
        wanted = word.encode(s, add_special_tokens=False).ids
        found = codec.encode(s)
        assert found == wanted and codec.decode(found) == word.decode(wanted, skip_special_tokens=False), repr(s)


def test_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    count, byte = bpe.PieceCounter(BYTE).of, Tokenizer.from_file(BYTE)
    for s in strings()[:200]:
        assert count(s) == len(byte.encode(s, add_special_tokens=False).ids)


def test_counts_of_odd_rows(odd, empty):
    found = token_counts.token_counts(odd, BYTE).collect()
    assert len(found) == odd.count()
    by = {r.doc_id: r for r in found if r.doc_id is not None}
    assert (by[1].n_bytes, by[1].n_tokens, by[1].over_limit) == (0, 0, False) and by[8].over_limit
    assert token_counts.token_counts(empty, BYTE).count() == 0


def test_codec_of_odd_rows(odd, empty):
    digests = {r.doc_id: r for r in bpe_codec.round_trip_digests(odd, WORD).collect()}
    assert digests[1].n_tokens == 0 and digests[1].ids_sha256 == hashlib.sha256(b"").hexdigest() == digests[3].decoded_sha256
    encoded = bpe_codec.encode_texts(odd, WORD)
    decoded = {r.doc_id: r.decoded for r in bpe_codec.decode_ids(encoded, WORD).collect()}
    for k in (4, 8, 10):
        assert hashlib.sha256(decoded[k].encode()).hexdigest() == digests[k].decoded_sha256
    assert bpe_codec.round_trip_digests(empty, WORD).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation_is_a_bijection(size):
    slots = training_order.Permutation(size, 9).slots(np.arange(size))
    assert sorted(slots.tolist()) == list(range(size))
    if size > 100:
        assert slots.tolist() != training_order.Permutation(size, 10).slots(np.arange(size)).tolist()


def test_shards_hold_every_token_once(spark, odd, empty):
    ranks = queries.vocabulary("byte_bpe_multi_50k.tiktoken")
    index, shards = training_order.write_shards(odd, ranks, tokens=64, records=16)
    index = {r.slot: r for r in index.collect()}
    read = {r.slot: r.ids for r in training_order.read_slots(spark, shards).collect()}
    assert sorted(read) == sorted(index) == list(range(shards.sequences))
    model = training_order.encoding(ranks)
    wanted = sorted(i for r in odd.collect() for i in [*model.encode_ordinary(r.text or ""), model.n_vocab])
    assert sorted(i for s, ids in read.items() for i in ids[:index[s].n_tokens]) == wanted
    assert all(r.shard == s // 16 and r.byte_offset == s % 16 * shards.stride for s, r in index.items())
    later = training_order.read_slots(spark, shards, first=20)
    assert {r.slot: r.ids for r in later.collect()} == {s: i for s, i in read.items() if s >= 20}
    nothing, place = training_order.write_shards(empty, ranks)
    assert nothing.count() == 0 == training_order.read_slots(spark, place).count()


def test_slots_contents_and_documents_by_hand(spark, odd):
    """Every slot, offset, id and document list from a permutation and a packing that are written out here."""
    ranks = queries.vocabulary("byte_bpe_multi_50k.tiktoken")
    docs = odd.select("doc_id", "text").coalesce(1)
    rows, tokens, records, key = docs.collect(), 32, 8, 77
    index, shards = training_order.write_shards(docs, ranks, tokens=tokens, records=records, seed=key)
    model = training_order.encoding(ranks)
    stream = [(i, r.doc_id) for r in rows for i in [*model.encode(r.text or "", disallowed_special=()), model.n_vocab]]
    size = -(-len(stream) // tokens)
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    keys = [int(k) for k in np.random.default_rng(key).integers(0, 1 << 64, 6, dtype=np.uint64)]

    def spread(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
        return x ^ x >> 29

    def slot(x):
        while True:
            left, right = x >> half, x % (1 << half)
            for k in keys:
                left, right = right, left ^ spread((right + k) % (1 << 64)) % (1 << half)
            x = left << half | right
            if x < size:
                return x

    want = {}
    for n in range(size):
        part = stream[n * tokens:(n + 1) * tokens]
        s = slot(n)
        documents = [k for i, (_, k) in enumerate(part) if i == 0 or part[i - 1][0] == model.n_vocab]
        ids = [i for i, _ in part] + [model.n_vocab] * (tokens - len(part))
        want[s] = (s // records, s % records * shards.stride, len(part), documents, ids)
    assert sorted(want) == list(range(size)) and size > 2000
    read = {r.slot: r.ids for r in training_order.read_slots(spark, shards).collect()}
    assert {r.slot: (r.shard, r.byte_offset, r.n_tokens, r.doc_ids, read[r.slot]) for r in index.collect()} == want


def test_frequent_pieces_outlive_a_full_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 10)
    made = []
    cache = bpe._Cache(lambda piece: made.append(piece) or len(piece))
    for i in range(200):
        assert cache["often"] == 5 and cache[f"rare {i}"] == len(f"rare {i}") and cache["x" * 99] == 99
        assert len(cache) <= 10 and len(cache.older) <= 10
    assert made.count("often") == 1 and made.count("x" * 99) == 200
