"""Lines as cuts of the encoder, and neighbours that are sorted only while they can be taken."""

import random

import numpy as np
import pyarrow as pa
import pytest
import regex

from tsquality.llm import common
from tsquality.llm import packing as P
from tsquality.llm import tokenids
from tsquality.llm.common import Encoder, byte_bpe


def _words(n):
    rng = random.Random(n)
    return list({"".join(rng.choices("abcdefghiéñß", k=rng.randint(3, 12))) for _ in range(n)})


@pytest.mark.parametrize("module, function", [(P, lambda: P._cut(byte_bpe(), 1, 2048, 50257, False)),
                                              (tokenids, lambda: tokenids.tokenized(byte_bpe(), 0, 50257))])
def test_new_words_are_merged_many_in_a_call(monkeypatch, module, function):
    enc, calls, words = Encoder(byte_bpe(), 1), [], _words(3000)
    merge = enc.merge
    enc.merge = enc.chunks.merge = lambda x: calls.append(x) or merge(x)
    monkeypatch.setattr(module, "encoder", lambda *_: enc)
    texts = [" ".join(words[k:k + 300]) + ".\nThen " + "! ".join(words[k:k + 200]) + " end" for k in range(0, len(words), 300)]
    rows = pa.RecordBatch.from_pydict({"doc_id": [*range(len(texts))], "text": texts})
    out = list(function()(iter([rows])))
    assert sum(b.num_rows for b in out) > len(texts)
    assert len(calls) < 100  # was one for each word


def test_ids_of_a_batch_are_the_librarys():
    rng = random.Random(11)
    parts = ["\n"] * 6 + [" "] * 12 + ["\t", "\x01", "\x00", "\x1c", "\xa0", "\u200b", "...", ",", "!!", "'s", "'", '"', "word", "The",
             "é", "ñgaes", "Ÿ", "ɏ", "ɐ", "ÿ", "ª", "º", "µ", "ǀ", "\u03a9m", "\u0301", "12", "½", "日本", "ß", "$$$", "a", "²", "<|endoftext|>"]
    for cache_mb in (0, 1):
        enc = Encoder(byte_bpe(), cache_mb)
        for n in (0, 1, 7, 2000, 2000):
            texts = [None if rng.random() < 0.01 else "".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(n)]
            texts += [" ".join(_words(n)), " \n".join(_words(n)), "\n".join(_words(n))]
            got = enc.encode_all(texts)
            assert len(got) == len(texts)
            for text, ids in zip(texts, got):
                want = enc.tokenizer.encode(text or "", add_special_tokens=False).ids
                assert np.frombuffer(ids, enc.dtype).tolist() == want, repr(text)
    assert enc.encode_all([]) == []


def test_letters_of_words_are_python_s_and_the_tokenizer_s():
    letters = {c for c in map(chr, range(0x250)) if regex.fullmatch(common._WORDS, c)}
    assert letters == {c for c in map(chr, range(0x250)) if c.isalpha()} == set(regex.findall(r"\p{L}", "".join(map(chr, range(0x250)))))


def test_kept_words_are_bounded_and_those_used_last_stay():
    made = []

    def make(words):
        made.extend(words.to_pylist())
        return words.cast(pa.large_binary())
    kept = common._Words(make, 4000)
    for k in range(50):
        some = ["often", *(f"w{k}x{j}" for j in range(30))]
        assert kept.ids_of(pa.array(some, pa.large_string())).to_pylist() == [w.encode() for w in some]
        assert kept.words.nbytes + kept.ids.nbytes + kept.used.nbytes <= 4000
    assert made.count("often") == 1
    kept.ids_of(pa.array(["long" * 2000], pa.large_string()))
    assert len(kept.words) == 0


def test_ids_over_line_feeds_are_the_librarys():
    enc, rng = Encoder(byte_bpe(), 1), random.Random(5)
    parts = ["\n"] * 6 + [" "] * 6 + ["\t", "\r", "\x01", " \x01", "\x1c", "\x85", "\xa0", "\u200b", "\ufeff", "\u2028", "\u3000", "...",
             ",", "!", "'s", "'", "word", "The", "é", "ñgaes", "Ÿ", "ɐ", "\u03a9m", "\u0301", "12", "½", "\u65e5\u672c", "ß", "$$$", "a"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(30_000)]
    texts += ["a\nb", "\nb", "a\n", "a.\nThe b", "a\n\nb", "a \nb", "a\n b", "a\x01b c\nd", "x\n's", "x\n...y", "\n", "a\nb\n\x01c"]
    for text in texts:
        want = np.array(enc.tokenizer.encode(text, add_special_tokens=False).ids, enc.dtype).tobytes()
        assert enc.encode(text) == want, repr(text)


def test_a_line_feed_parts_chunks():
    enc = Encoder(byte_bpe(), 1)
    enc.encode("so that.\nHeed this")
    assert "that." in enc.chunks and not any("\n" in c for c in enc.chunks)


def _shard(rng, lengths):
    tails = [np.append(rng.integers(1, 40, n - 1), 0).astype(np.uint16) for n in lengths]
    df = np.bincount(np.concatenate([np.unique(x) for x in tails]), minlength=50)
    idf = np.log1p((len(tails) - df + 0.5) / (df + 0.5))
    return P.Shard(tails, idf, float(np.mean(lengths)), 1.2, 0.75)


def test_neighbours_that_do_not_fit_are_not_sorted(monkeypatch):
    yielded, ranked = [], P.Shard.ranked

    def counted(self, *args):
        for near in ranked(self, *args):
            yielded.append(len(near))
            yield near
    monkeypatch.setattr(P.Shard, "ranked", counted)
    lengths = [1500] * 400
    P.fill(_shard(np.random.default_rng(1), lengths), lengths, 2048)
    assert sum(yielded) < 400 * 70  # each of the seeds sorted nearly all that were left: about 60,000


def test_pieces_are_those_of_a_full_ranking(monkeypatch):
    ranked = P.Shard.ranked
    for seed in range(12):
        rng = np.random.default_rng(seed)
        lengths = rng.integers(1, 200, 150).tolist()
        got = P.fill(_shard(rng, lengths), lengths, 256, first=1 + seed)
        rng = np.random.default_rng(seed)
        rng.integers(1, 200, 150)
        with monkeypatch.context() as m:
            m.setattr(P.Shard, "ranked", lambda self, s, unused, terms, first, wanted=None: ranked(self, s, unused, terms, len(lengths)))
            assert got == P.fill(_shard(rng, lengths), lengths, 256)
