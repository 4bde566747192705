"""Scoring texts with a weighted backoff automaton, learned from the corpus itself.

The model is an n-gram model with Dirichlet smoothing: with c counts of the training texts,

    p(w | h) = (c(h w) + m * p(w | h without its first word)) / (c(h) + m),

and at the root p(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)), where unknown words share one class. As an
automaton: contexts are states, an n-gram that was seen is an arc of weight log p from its context to
the longest suffix that is a state, and each state has a failure arc of weight log(m / (c(h) + m)) to
its context without the first word. A text is one left-to-right traversal from the root that carries
the state and adds up weights.

The counts of a large corpus fit no task, so the automaton is never in one place. Documents are
dealt to shards of bounded size. Each shard lists its distinct n-grams with their counts in its
training documents, as sorted 64-bit keys in one packed row for each part of the key space. A part adds
up the counts of each key over all shards and answers each shard in the shard's own order, so that
no key travels back. With the answers a shard has all states and arcs that its documents can
reach, builds that piece of the automaton, and traverses its documents; as the n-grams of its texts are
numbered already, a token's arcs need no search. Words are keyed by XXH64 and
longer n-grams by a mix of their words' keys; two of a billion different keys collide with a
probability of some 3 %, and would then share their counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tsquality.llm.common import lower_words, row_hash

_KEYS = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n", pa.int64()), ("words", pa.int64()),
                   ("train_tokens", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_KEYS_DDL = "part INT, shard INT, n BIGINT, words BIGINT, train_tokens BIGINT, keys BINARY, counts BINARY"
_SUMS_DDL = "shard INT, part INT, counts BINARY, vocabulary BIGINT, train_tokens BIGINT"
_SCORES_DDL = ("doc_id BIGINT, held_out BOOLEAN, n_tokens BIGINT, n_known BIGINT, train_tokens BIGINT, "
               "base_score DOUBLE, score DOUBLE")

#: The end of a text; no word is empty, so its key is no word's but by collision.
_END = b""


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys of n-grams from the keys of their first n - 1 words and of their last one."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
        return x ^ (x >> np.uint64(32))


def planes(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane: the high planes are nearly empty and compress away."""
    return np.ascontiguousarray(np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).reshape(-1).view(np.uint64),
                     dtype=np.uint64)


class Grams:
    """The distinct n-grams of a shard's documents, up to ``order`` words."""

    def __init__(self, texts: list[str | None], train: np.ndarray, order: int):
        docs = [lower_words(t) + [_END] for t in texts]
        self.lengths = np.array([len(d) for d in docs], np.int64)
        words = np.empty(int(self.lengths.sum()), object)
        words[:] = [w for d in docs for w in d]
        ids, distinct = pd.factorize(words)
        del words, docs
        keys = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
        self.end = int(np.flatnonzero(distinct == _END)[0])
        self.n_words = len(distinct)
        place = np.arange(len(ids)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        train_at = np.repeat(train, self.lengths)
        self.word_at = ids.astype(np.int64)
        #: By level: the id at each token of the n-gram that ends there (-1: the text is too short), keys,
        #: counts in training documents, ids of the prefix and the suffix one level below, and of the last word.
        self.at = [self.word_at]
        self.keys, self.local = [keys], [np.bincount(ids[train_at], minlength=len(keys))]
        self.prefix, self.suffix, self.last = [None], [None], [np.arange(len(keys))]
        for level in range(1, order):
            below = self.at[-1]
            ends = np.flatnonzero(place >= level)
            code = below[ends - 1] * self.n_words + self.word_at[ends]
            _, first, own = np.unique(code, return_index=True, return_inverse=True)
            at = np.full(len(ids), -1, np.int64)
            at[ends] = own
            example = ends[first]
            self.at.append(at)
            self.prefix.append(below[example - 1])
            self.suffix.append(below[example])
            self.last.append(self.word_at[example])
            self.keys.append(_mixed(self.keys[-1][below[example - 1]], keys[self.word_at[example]]))
            self.local.append(np.bincount(own[train_at[ends]], minlength=len(first)))

    def sorted_keys(self, parts: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Order of all n-grams by (part, key), the keys less the part's bits in that order, each part's bounds."""
        keys = np.concatenate(self.keys)
        bits = np.uint64(parts.bit_length() - 1)
        # The part's bits first: one sort gives parts in order and keys in order inside.
        turned = keys if not bits else (keys << (np.uint64(64) - bits)) | (keys >> bits)
        order = np.argsort(turned, kind="stable")
        turned = turned[order]
        edges = np.searchsorted(turned >> (np.uint64(64) - bits), np.arange(parts, dtype=np.uint64)) if bits else [0]
        mask = np.uint64((1 << (64 - int(bits))) - 1)
        return order, turned & mask, [*map(int, edges), len(turned)]


def _listed(order: int, parts: int):
    """applyInArrow function: a shard's documents to a row of keys and counts for each part."""
    def run(docs: pa.Table) -> pa.Table:
        train = ~docs.column("held_out").to_numpy()
        grams = Grams(docs.column("text").to_pylist(), train, order)
        at, keys, edges = grams.sorted_keys(parts)
        counts = np.concatenate(grams.local)[at].astype("<u4")
        is_word = at < grams.n_words
        shard = docs.column("shard")[0].as_py()
        rows = {f.name: [] for f in _KEYS}
        for p, (a, z) in enumerate(zip(edges, edges[1:])):
            # Word keys are told from others by their place: a bit a key.
            row = (p, shard, z - a, 0, int(grams.local[0].sum()) if p == 0 else 0, planes(keys[a:z]),
                   counts[a:z].tobytes() + np.packbits(is_word[a:z]).tobytes())
            for f, x in zip(_KEYS, row):
                rows[f.name].append(x)
        return pa.table({f.name: pa.array(rows[f.name], f.type) for f in _KEYS})
    return run


def _added(table: pa.Table) -> pa.Table:
    """applyInArrow function: all shards' rows of a part to each shard's counts over all shards."""
    rows = table.to_pylist()
    n = [r["n"] for r in rows]
    if not sum(n):
        distinct = total = np.empty(0)
        inverse, words = np.empty(0, int), np.empty(0, bool)
    else:
        keys = np.concatenate([from_planes(r["keys"]) for r in rows if r["n"]])
        local = np.concatenate([np.frombuffer(r["counts"][:4 * r["n"]], "<u4") for r in rows])
        words = np.concatenate([np.unpackbits(np.frombuffer(r["counts"][4 * r["n"]:], np.uint8), count=r["n"])
                                for r in rows]).astype(bool)
        distinct, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse, weights=local, minlength=len(distinct)).astype(np.int64)
    seen = np.zeros(len(distinct), bool)
    seen[inverse[words]] = True
    vocabulary = int((seen & (total > 0)).sum())
    train_tokens = sum(r["train_tokens"] for r in rows)
    ends = np.cumsum([0, *n])
    return pa.table({
        "shard": pa.array([r["shard"] for r in rows], pa.int32()), "part": pa.array([r["part"] for r in rows], pa.int32()),
        "counts": pa.array([_narrow(total[inverse[a:z]]) for a, z in zip(ends, ends[1:])], pa.binary()),
        "vocabulary": pa.array([vocabulary] * len(rows), pa.int64()),
        "train_tokens": pa.array([train_tokens] * len(rows), pa.int64())})


def _narrow(counts: np.ndarray) -> bytes:
    """Counts as bytes, those of 255 and more apart."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    large = counts == 255
    counts[large] = np.frombuffer(raw, "<i8", offset=n)
    return counts


#: Stands for an arc that is not there: no log-probability is positive.
_NO_ARC = 1.0


class Automaton:
    """States and arcs for the n-grams of a shard, given their counts in the whole training corpus.

    The state of a context is its n-gram, the arc of a word that follows it is the longer n-gram, and
    the failure arc of a state goes to the context without its first word; a state is told by the
    length of its context and the token that it ends at. Weights stand in arrays by n-gram.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], train_tokens: int, vocabulary: int, strength: list[float]):
        floor = train_tokens + 0.1 * (vocabulary + 1)
        p = (counts[0] + 0.1) / floor
        self.unknown = float(np.log10(0.1 / floor))
        self.base = np.log10(p)
        self.arc, self.fail = [np.where(counts[0] > 0, self.base, _NO_ARC)], []
        for level in range(1, len(counts)):
            m = strength[level - 1]
            self.fail.append(np.log10(m / (counts[level - 1] + m)))
            seen = counts[level] > 0
            context = counts[level - 1][grams.prefix[level]]
            p = (counts[level] + m * p[grams.suffix[level]]) / (context + m)
            self.arc.append(np.where(seen, np.log10(p), _NO_ARC))

    def tracks(self, grams: Grams) -> tuple[list[list[float]], list[list[float]]]:
        """For each token, by length of context: the weight of the arc that reads it, and of the failure
        arc of the state before it."""
        arcs = [np.where(at >= 0, w[at], _NO_ARC).tolist() for w, at in zip(self.arc, grams.at)]
        fails = [[0.0] + w[at[:-1]].tolist() for w, at in zip(self.fail, grams.at)]
        return arcs, fails

    def score(self, arcs: list[list[float]], fails: list[list[float]]) -> float:
        """Sum of log10 p over one text's tokens: a traversal from the root that carries the state."""
        longest, unknown = len(fails), self.unknown
        total, state = 0.0, 0  # the length of the context: 0 is the root
        for reads, fallen in zip(zip(*arcs), zip(*fails)):
            weight = reads[state]
            while weight == _NO_ARC:
                if not state:
                    weight, state = unknown, -1
                    break
                state -= 1
                total += fallen[state]
                weight = reads[state]
            total += weight
            if state < longest:
                state += 1
        return total


def _scored(order: int, parts: int, strength: list[float]):
    """cogroup function: a shard's documents and the answers of all parts to scores."""
    def run(docs: pa.Table, sums: pa.Table) -> pa.Table:
        held_out = docs.column("held_out").to_numpy()
        grams = Grams(docs.column("text").to_pylist(), ~held_out, order)
        at, _, edges = grams.sorted_keys(parts)
        answers = {r["part"]: r for r in sums.to_pylist()}
        flat = np.empty(len(at), np.int64)
        for p, (a, z) in enumerate(zip(edges, edges[1:])):
            flat[at[a:z]] = _wide(answers[p]["counts"], z - a)
        sizes = np.cumsum([0, *(len(k) for k in grams.keys)])
        counts = [flat[a:z] for a, z in zip(sizes, sizes[1:])]
        train_tokens = answers[0]["train_tokens"]
        machine = Automaton(grams, counts, train_tokens, sum(r["vocabulary"] for r in answers.values()), strength)
        del answers, flat
        ends = np.cumsum(grams.lengths)
        begins = ends - grams.lengths
        known = np.add.reduceat((counts[0] > 0)[grams.word_at].astype(np.int64), begins)
        base = np.add.reduceat(machine.base[grams.word_at], begins)
        arcs, fails = machine.tracks(grams)
        score = [machine.score([x[a:z] for x in arcs], [x[a:z] for x in fails]) for a, z in zip(begins, ends)]
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": docs.column("held_out"), "n_tokens": pa.array(grams.lengths),
            "n_known": pa.array(known), "train_tokens": pa.array([train_tokens] * len(score), pa.int64()),
            "base_score": pa.array(base), "score": pa.array(score)})
    return run


def scored(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2,
           strength: tuple[float, ...] = (400.0, 20.0), shard_chars: int = 5_000_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs``.

    The model learns from the rows for which ``held_out`` is false. A null or empty text is the end
    token alone; rows with equal or null ids are scored, and learned from, each on its own; without
    training rows every token is unknown, of probability 1. An empty table gives no row; other
    columns are not read. ``strength`` is m of the smoothing, by length of context.
    """
    if order < 2:
        raise ValueError("order is 2 or more")
    docs, place = row_hash(docs)  # repeated rows, however many, are dealt to all shards
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"), place.alias("place"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-chars // shard_chars))
    parts = 1 << (max(1, chars // 4_000_000) - 1).bit_length()
    dealt = rows.withColumn("shard", F.pmod("place", F.lit(shards)).cast("int")).drop("place") \
        .repartition(shards, "shard")
    listed = dealt.groupBy("shard").applyInArrow(_listed(order, parts), _KEYS_DDL)
    sums = listed.repartition(parts, "part").groupBy("part").applyInArrow(_added, _SUMS_DDL)
    return dealt.groupBy("shard").cogroup(sums.repartition(shards, "shard").groupBy("shard")).applyInArrow(
        _scored(order, parts, list(strength[:order - 1])), _SCORES_DDL)
