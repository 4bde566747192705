"""Helpers that several operators share: tables, scratch tables, Arrow batches, token ids."""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tsquality.session import prepare, scratch_path

#: A word, as every contract here defines it. ``bytes.split()`` splits on exactly these separators.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: computed once, and
    lost executors do not cause it to be computed again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_hash(docs: DataFrame) -> tuple[DataFrame, Column]:
    """``docs`` and a hash that differs between its rows, also equal ones, and is the same in every scan: of a file's
    name and the row's place in it, or, where ``docs`` is no scan of files, of a number written beside the rows."""
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    try:
        docs.select(place).schema
        return docs, place
    except AnalysisException:
        name = "row_number_"
        while name in {c.lower() for c in docs.columns}:
            name += "_"
        return written(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), F.xxhash64(name)


def parts_for(total: int | float | None, each: int) -> int:
    """How many partitions hold ``total`` at about ``each``."""
    return max(1, -(-int(total or 0) // each))


def crc_mod(col: str, mod: int):
    """crc32 of an id written as text, modulo ``mod`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def lower_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased; ``bytes`` methods touch ASCII alone."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


# -- token ids ---------------------------------------------------------------

#: White space for the tokenizer's pre-split: a space with white space (or the end) on both sides.
_SPACES = r"\s\x1c-\x1f\x85\xa0\u180e\u200b-\u200d\u2060\ufeff"
_JOINED_SPACES = re.compile(rf" (?<=[{_SPACES}] )(?=[{_SPACES}]|\Z)")

_OTHER_SPACES = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"


#: All that may be white space to some version of Unicode.
_BLANK = frozenset(re.findall(rf"[{_SPACES}]", "".join(map(chr, range(0x10000)))))


def _crossed(text: str) -> bool:
    """Whether a run of white space crosses a space: one that has white space before it and after it, or the end."""
    if text.isascii() and "  " not in text and not any(c in text for c in _OTHER_SPACES):
        return "\n \n" in text or text.endswith("\n ")
    return _JOINED_SPACES.search(text) is not None


#: Stands before a chunk that begins a line, and so has no space before it.
_LINE = "\x01"


def _plain(lines: list[str]) -> bool:
    """Whether every line feed stands between characters that are no white space, so that a piece ends before it."""
    for x in lines:
        if not x or x[0] in _BLANK or x[-1] in _BLANK:
            return False
    return True


#: How a byte-level tokenizer splits (fixed value), and the letter that stands for each byte: bytes that
#: print stand for themselves, the others in order for the letters from U+0100 on.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_OTHERS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_SYMBOLS = "!#$%&()*+,-./:;<=>?@[]^_{|}~"
_BYTE_LEVEL = [chr(0x100 + _OTHERS.index(b) if b in _OTHERS else b) for b in range(256)]

#: Stands between words that go through the library's merges in one call: the letter of a byte that UTF-8 has not, so
#: that no merge has it. It is written for byte 0, which no word has.
_PART = _BYTE_LEVEL[0xFF]
_LETTERS = np.array([ord(_PART), *map(ord, _BYTE_LEVEL[1:])], "<u4")

#: A chunk of a word of letters before U+0250, also one that begins a line, and symbols: two pieces at most, without the line feed.
_WORDS = rf"^(?P<word>{_LINE}?[A-Za-zªµºÀ-ÖØ-öø-ɏ]+)(?P<rest>[{re.escape(_SYMBOLS)}]*)$"


def _known(chunk: str) -> bool:
    """Whether all characters stand before U+0250; beyond these letters, versions of Unicode may differ."""
    if chunk.isascii():
        return True
    try:
        chunk.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return max(chunk) < "\u0250"


class _Chunks(dict):
    """The ids of a space and a chunk, by chunk; what is not there is made and kept."""

    def __init__(self, encoder: Encoder, older: dict):
        super().__init__()
        self.merge, self.code, self.spaced, self.line, self.older = (
            encoder.merge, encoder.code, encoder._spaced, encoder._line, older)

    def __missing__(self, chunk: str) -> bytes:
        got = self.older.get(chunk)
        if got is None:
            if chunk.isalpha() and chunk.isascii():  # one piece, and bytes that stand for themselves
                got = array(self.code, [t.id for t in self.merge("\u0120" + chunk)]).tobytes()
            elif chunk[:1] == _LINE:
                got = self.line(chunk[1:])
            else:
                got = self.spaced(chunk)
        self[chunk] = got
        return got


def _binaries(cuts: np.ndarray, data: np.ndarray) -> pa.Array:
    """The bytes of ``data`` between the cuts."""
    cuts = cuts.astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)])


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def _joined(*parts: pa.Array | str | bytes) -> pa.Array:
    """The parts of each row one after the other; null if one is."""
    kind = next(x.type for x in parts if isinstance(x, pa.Array))
    nothing = "" if kind == pa.large_string() else b""
    return pc.binary_join_element_wise(*(x if isinstance(x, pa.Array) else pa.scalar(x, kind) for x in parts), pa.scalar(nothing, kind))


class _Words:
    """Words and their ids as Arrow arrays of some bytes at most: of more, the half used last stays."""

    def __init__(self, made: Callable[[pa.Array], pa.Array], most: int):
        self.made, self.most, self.calls = made, most, 0
        self.words, self.ids, self.used = pa.array([], pa.large_string()), pa.array([], pa.large_binary()), np.zeros(0, np.int32)

    def ids_of(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words; what is not there is made and kept."""
        self.calls += 1
        at = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = words.filter(pa.array(at < 0))
        at[at < 0] = len(self.words) + np.arange(len(new))
        self.words, self.ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, self.made(new)])
        self.used = np.append(self.used, np.zeros(len(new), np.int32))
        self.used[at] = self.calls
        got = self.ids.take(pa.array(at))
        while self.words.nbytes + self.ids.nbytes + self.used.nbytes > self.most:
            last = pa.array(np.sort(np.argsort(-self.used, kind="stable")[:len(self.used) // 2]))
            self.words, self.ids, self.used = self.words.take(last), self.ids.take(last), self.used[last]
        return got


class Encoder:
    """Token ids of whole texts by a file of the ``tokenizers`` library, as packed bytes.

    For a byte-level BPE the ids of ``" word"`` do not depend on what stands around it, unless
    a run of white space crosses the cut. So a text is cut before its spaces, each distinct
    chunk is split as the library's pre-tokenizer splits, each distinct piece goes through the
    library's merges once, and the results are joined. Where a single line feed parts two lines, a
    text is cut before it too. Texts with such runs, or with a special token's string, go through the library whole. What is kept is bounded by ``cache_mb``: two
    generations of chunks, of which the older goes when the younger is full, and pieces.

    ``encode_all`` gives the same ids for the texts of a batch: Arrow cuts them, finds the distinct chunks and parts
    their words from the symbols after them, words that are not known yet go through the library's merges many in a
    call, and Arrow joins the results. A quarter of ``cache_mb`` is for these words.
    """

    #: What a chunk and its ids take (measured: 226 MB for 1.33 million).
    BYTES_EACH = 170
    #: Words in one string for the library.
    TOGETHER = 64

    def __init__(self, path: str, cache_mb: int = 240):
        self.keep = max(1, cache_mb * 750_000 // (2 * self.BYTES_EACH))
        self.words = _Words(self._made, cache_mb * 250_000)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        pre = conf.get("pre_tokenizer") or {}
        self.simple = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                       and not pre.get("add_prefix_space") and conf.get("normalizer") is None)
        merges = Tokenizer.from_file(path).model
        if hasattr(merges, "_resize_cache"):
            merges._resize_cache(0)  # pieces are kept here; the library's own cache would only be searched in vain
        self.merge = merges.tokenize
        self.bare = Tokenizer(merges)  # no pre-tokenizer: the merges of a whole string
        model = conf["model"]
        #: Whether merges stay between two parting letters, so that words side by side are merged each on its own.
        self.parts = self.simple and model.get("type") == "BPE" and _PART in model["vocab"] and not (
            any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
            or any(_PART in x for m in model["merges"] for x in m))
        self.part_id = model["vocab"].get(_PART) if self.parts else None
        self.special = [t["content"] for t in conf.get("added_tokens", [])]
        self.dtype = id_dtype(self.tokenizer.get_vocab_size())
        self.code = "H" if self.dtype == "<u2" else "I"
        self.chunks = _Chunks(self, {})
        self.inner: dict[str, bytes] = {}  # the ids of a piece without a space

    def _packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        return self._packed([t.id for t in self.merge("".join(map(_BYTE_LEVEL.__getitem__, piece.encode("utf-8"))))])

    def _chunk(self, chunk: str) -> bytes:
        if not _known(chunk):
            return b"".join(self._packed([t.id for t in self.merge(x)])
                            for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk))
        pieces = _PIECES.findall(chunk)
        if len(pieces) == 1:
            return self._piece(chunk)
        return b"".join(self.chunks[x[1:]] if x[0] == " " and len(x) > 1 else self._inner(x) for x in pieces)

    def _spaced(self, chunk: str) -> bytes:
        word = chunk.rstrip(_SYMBOLS)
        if word.isalpha() and _known(word):  # one piece, and a run of symbols is another
            return self.chunks[word] + self._inner(chunk[len(word):]) if len(word) < len(chunk) else self._piece(" " + word)
        return self._chunk(" " + chunk)

    def _line(self, chunk: str) -> bytes:
        """A line feed and the chunk that begins the line."""
        word = chunk.rstrip(_SYMBOLS)
        if word.isalpha() and _known(word):
            return self._inner("\n") + self._inner(word) + (self._inner(chunk[len(word):]) if len(word) < len(chunk) else b"")
        return self._inner("\n") + self._chunk(chunk)

    def _inner(self, piece: str) -> bytes:
        got = self.inner.get(piece)
        if got is None:
            if 4 * len(self.inner) >= self.keep:
                self.inner.clear()
            got = self.inner[piece] = self._piece(piece)
        return got

    def _lined(self, text: str) -> str | None:
        """``text`` to be cut before its spaces, of which some stand for line feeds; None if it is not to be cut."""
        if not self.simple or any(s in text for s in self.special) or _LINE in text or _crossed(text):
            return None
        if "\n" in text and _plain(lines := text.split("\n")):
            return f" {_LINE}".join(lines)
        return text

    def _drop_old(self) -> None:
        if len(self.chunks) >= self.keep:
            self.chunks.older = {}  # what was kept before it goes
            self.chunks = _Chunks(self, self.chunks)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        text, whole = self._lined(text), text
        if text is None:
            return self._whole(whole)
        self._drop_old()
        first, *rest = text.split(" ")
        ids = b"".join(map(self.chunks.__getitem__, rest))
        return (self._chunk(first) if first else b"") + ids

    def _merged(self, words: pa.Array, before: str) -> pa.Array:
        """The ids of each word, after ``before``; ``words`` have letters alone."""
        marked = _joined(before, words, "\0")
        raw = np.frombuffer(marked.buffers()[2] or b"", np.uint8)
        cuts = np.frombuffer(marked.buffers()[1], np.int64)[:len(words) + 1]
        parts, step = [np.zeros(0, self.dtype)], 64 * self.TOGETHER
        for at in range(0, len(words), step):
            here = [*cuts[at:at + step:self.TOGETHER].tolist(), int(cuts[min(at + step, len(words))])]
            strings = [_LETTERS[raw[x:y]].tobytes().decode("utf-32-le") for x, y in zip(here, here[1:])]
            parts += [np.array(x.ids, self.dtype) for x in self.bare.encode_batch_fast(strings, add_special_tokens=False)]
        ids = np.concatenate(parts)
        ends = np.flatnonzero(ids == self.part_id)
        return _binaries(np.append(0, ends - np.arange(len(ends))) * ids.itemsize, ids[ids != self.part_id])

    def _made(self, words: pa.Array) -> pa.Array:
        """The ids of a space and a word, or of a line feed and a word that begins a line."""
        begins = pc.starts_with(words, _LINE)
        line = self._merged(pc.utf8_slice_codeunits(words.filter(begins), 1), "")
        line = _joined(self._inner("\n"), line)
        both = pa.concat_arrays([self._merged(words.filter(pc.invert(begins)), " "), line])
        return both.take(pa.array(np.argsort(np.argsort(begins.to_numpy(zero_copy_only=False), kind="stable"))))

    def _all_chunks(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Arrays of ids, and which of them is that of a space and a chunk, for each of many distinct chunks."""
        self._drop_old()
        found = pc.extract_regex(chunks, _WORDS)
        word, rest = (pc.struct_field(found, k).dictionary_encode() for k in ("word", "rest"))
        symbols = pa.array([self._inner(x) if x else b"" for x in _strings(rest.dictionary)], pa.large_binary())
        ids = _joined(self.words.ids_of(word.dictionary).take(word.indices), symbols.take(rest.indices))
        other = np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False))
        singly = [self._line(c[1:]) if c[:1] == _LINE else self.chunks[c] for c in _strings(chunks.take(pa.array(other)))]
        where = np.arange(len(chunks))
        where[other] = len(chunks) + np.arange(len(other))
        return pa.concat_arrays([ids, pa.array(singly, pa.large_binary())]), where

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """``encode`` of each text. Beside the texts it holds their chunks once, as Arrow arrays."""
        if not self.parts:
            return [self.encode(t) for t in texts]
        out, rests = [], []
        for t in texts:
            lined = self._lined(t) if t else ""
            first, space, rest = ("", "", "") if lined is None else lined.partition(" ")
            rests.append(rest if space else None)
            out.append(self._whole(t) if lined is None else self._chunk(first) if first else b"")
        cut = pc.split_pattern(pa.array(rests, pa.large_string()), " ")
        coded = cut.values.dictionary_encode()
        ids, where = self._all_chunks(coded.dictionary)
        ids = ids.take(pa.array(where[coded.indices.to_numpy()]))
        ends = np.frombuffer(ids.buffers()[1], np.int64)[cut.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(out) + 1)
        raw = memoryview(ids.buffers()[2] or b"")
        return [a + raw[at:to] for a, at, to in zip(out, ends, ends[1:])]


@lru_cache(maxsize=1)
def encoder(path: str, cache_mb: int = 240) -> Encoder:
    """One encoder for all tasks of a Python worker: what it has kept serves the next task too."""
    return Encoder(path, cache_mb)


def id_dtype(vocab: int) -> str:
    return "<u2" if vocab <= 1 << 16 else "<u4"


def vocab_size(path: str) -> int:
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path).get_vocab_size()


def byte_bpe() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def id_counts(arrays: DataFrame, size: int) -> DataFrame:
    """id, n: the sums over one column of arrays, each ``size`` packed 64-bit counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            for x in b.column(0):
                total += np.frombuffer(x.as_py(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["id", "n"])
    # A task sums up many arrays, so that few rows of the vocabulary's size are shuffled.
    few = arrays.coalesce(max(4, len(arrays.inputFiles()) // 64))
    return few.mapInArrow(run, "id BIGINT, n BIGINT").groupBy("id").agg(F.sum("n").alias("n"))


# -- Arrow -------------------------------------------------------------------

def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def gathered(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    """All batches of one partition; only for partitions whose size the caller has bounded."""
    got = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(got) if got else None


def binary(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()
