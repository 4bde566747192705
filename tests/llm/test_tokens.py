"""Token archives (10) and packing (1)."""

import inspect
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tsquality.llm import packing, tokenids
from tsquality.llm.common import Encoder, byte_bpe

from edge import documents, stored

TK = Tokenizer.from_file(byte_bpe())
ENC = Encoder(byte_bpe())


def ids_of(text, end):
    return np.array(TK.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "a", "Zé", "'s", "%", "12", "\t", "\xa0", ".", "日", "　", "\x1c", "ª",
                                 "<|endoftext|>", "\x00", "²", "\U0001F600"]), max_size=14))
def test_encoder_equals_the_library(parts):
    text = "".join(parts)
    assert np.frombuffer(ENC.encode(text), ENC.dtype).tolist() == TK.encode(text, add_special_tokens=False).ids


def test_encoder_drops_old_chunks():
    e = Encoder(byte_bpe())
    e.keep = 8
    for k in range(200):
        text = f"w{k} common w{k + 1}, word{k % 7}."
        assert np.frombuffer(e.encode(text), e.dtype).tolist() == TK.encode(text, add_special_tokens=False).ids
    assert len(e.chunks) + len(e.chunks.older) + len(e.inner) < 60 and not e.chunks.older.older


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=300))
def test_code_round_trip(values):
    r = np.array(values, np.uint32)
    control, data = tokenids.pack(r)
    assert len(control) == -(-len(r) // 4)
    assert tokenids.unpack(control, data, len(r)).tolist() == values


def test_archive(spark, tmp):
    docs = stored(documents(spark), tmp, "documents")
    path = f"{tmp}/archive"
    tokenids.write_archive(docs, path, byte_bpe(), part_ids=9_000, block_ids=2_000)
    got = [r.asDict() for r in tokenids.read_archive(spark, path, with_ids=True).collect()]
    want = docs.select("doc_id", "text").collect()
    assert len(got) == len(want)
    got.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((r.doc_id for r in want), key=lambda i: (i is not None, i))
    texts = defaultdict(list)
    for r in want:
        texts[r.doc_id].append(ids_of(r.text, 0).tobytes())
    at = 0
    for r in got:
        raw = bytes(r["ids"])
        texts[r["doc_id"]].remove(raw)
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(raw) // 4, zlib.crc32(raw))
        at += r["n_tokens"]
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()
    assert sorted(r.id for r in ranks) == list(range(TK.get_vocab_size()))
    assert spark.read.parquet(f"{path}/blocks").select("part").distinct().count() > 3


def test_archive_of_nothing(spark, tmp):
    assert tokenids.token_archive(stored(documents(spark, empty=True), tmp, "documents"), byte_bpe()).collect() == []


@pytest.mark.parametrize("shard_tokens", [3_000, 2_000_000])
def test_packing(spark, tmp, shard_tokens):
    docs = stored(documents(spark), tmp, "documents")
    pieces = [r.asDict() for r in packing.pack_documents(docs, byte_bpe(), shard_tokens=shard_tokens, with_ids=True).collect()]
    sequences, of_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        x = np.frombuffer(bytes(p["ids"]), "<u2").astype("<u4")
        assert p["length"] == len(x) > 0 and p["ids_crc32"] == zlib.crc32(x.tobytes())
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        of_doc[p["doc_id"]].append((p["start"], p["doc_tokens"], tuple(x.tolist())))
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 2048
    want = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        want[r.doc_id].append(tuple(ids_of(r.text, 1).tolist()))
    for doc, texts in want.items():
        # Rows with equal ids may be told apart by nothing but their ids: match pieces by content.
        have = sorted(of_doc[doc])
        assert sum(len(x) for _, _, x in have) == sum(map(len, texts))
        if len(texts) == 1:
            assert tuple(i for _, _, x in have for i in x) == texts[0]
            assert {n for _, n, _ in have} == {len(texts[0])}
    if shard_tokens > 1_000_000:  # one shard: only the last sequence is not full
        assert sum(sum(n for _, n in s) < 2048 for s in sequences.values()) <= 1


def test_packing_nothing(spark, tmp):
    assert packing.pack_documents(stored(documents(spark, empty=True), tmp, "documents"), byte_bpe()).collect() == []


def test_neighbours_are_bm25_best():
    rng = np.random.default_rng(3)
    tails = [rng.integers(0, 30, rng.integers(1, 20)).astype("<u2") for _ in range(40)]
    df = np.zeros(50, int)
    for t in tails:
        df[np.unique(t)] += 1
    idf = np.log1p((40 - df + 0.5) / (df + 0.5))
    mean = np.mean([len(t) for t in tails])
    shard = packing.Shard(tails, idf, mean, 1.2, 0.75)

    def weight(term, tail):
        tf = (tail == term).sum()
        return idf[term] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(tail) / mean))
    unused = np.ones(40, bool)
    unused[[0, 5, 9]] = False
    got = shard.neighbours(0, unused, 100, 1000)
    score = {k: sum(weight(t, tails[k]) for t in set(tails[0].tolist())) for k in np.flatnonzero(unused)}
    assert sorted(got) == sorted(k for k in score if score[k] > 0)
    assert all(score[a] >= score[b] - 1e-9 for a, b in zip(got, got[1:]))
    assert shard.neighbours(0, unused, 100, 7) == got[:7]
    assert shard.neighbours(0, unused, 3, 10)  # fewer query terms, still whole documents


def test_windows_hold_related_documents():
    tails = [np.array([k % 3 * 10 + j for j in range(8)], "<u2") for k in range(12)]
    df = np.bincount(np.concatenate(tails), minlength=64)
    shard = packing.Shard(tails, np.log1p((12 - df + 0.5) / (df + 0.5)), 8, 1.2, 0.75)
    pieces = packing.fill(shard, [8] * 12, 32, 48)
    for s in range(3):
        assert len({k % 3 for q, _, k, _, _ in pieces if q == s}) == 1


def test_windows_of_short_tails_are_all_retrieved():
    """More neighbours fit a window than are sorted at first, and one shares only a common term with the seed."""
    tails = [np.array([k % 2 * 10 + j for j in range(8)], "<u2") for k in range(256)]
    df = np.bincount(np.concatenate(tails), minlength=64)
    shard = packing.Shard(tails, np.log1p((256 - df + 0.5) / (df + 0.5)), 8, 1.2, 0.75)
    pieces = packing.fill(shard, [8] * 256, 1024, 48)
    assert len(pieces) == 256
    for s in range(2):
        assert {k % 2 for q, _, k, _, _ in pieces if q == s} == {s}
    own = np.arange(100, 160, dtype="<u2")
    tails = [np.array(x, "<u2") for x in ([*own, 1], [2, 3], [*own, 4], [1, 5], [1, 6])]
    df = np.bincount(np.concatenate(tails), minlength=200)
    shard = packing.Shard(tails, np.log1p((5 - df + 0.5) / (df + 0.5)), 26, 1.2, 0.75)
    asked = inspect.signature(packing.pack_documents).parameters["query_terms"].default
    pieces = packing.fill(shard, [len(t) for t in tails], 126, asked)
    assert [k for q, _, k, _, _ in pieces if q == 0] == [0, 2, 3, 4]
