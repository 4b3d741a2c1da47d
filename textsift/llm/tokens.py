"""Token-ID store: tokenised documents in files of adaptively coded blocks (operator 5).

Documents are dealt to ranges of their id and sorted, tokenised whole, and written in groups. A group lists its runs
of ids once, the most frequent first (a run: the ids of one word, or one id where the tokenizer can't go by word); its documents,
with an end id each, are then a sequence of run numbers, cut into blocks that ``idcoder`` codes on their own. A file is a
sequence of frames, each

    magic ``TSID``, kind (``D``, ``R``, ``A`` or ``B``), payload length (u32), CRC-32 of kind and payload (u32), payload, line feed

A ``D`` frame lists the documents of a group: part, number, then ids, id flags and counts of runs. ``R`` holds the runs and ``A`` the
alphabets of the blocks, both compressed. A ``B`` frame is a block: number of runs, CRC-32 of the run numbers as
little-endian u32, code. Spark's text writer puts the bytes down; the line feed is its line end.

Tokenising is by word where the tokenizer drops white space and no token spans it: a text's ids are then those of its words
one after another, and equal words are encoded once for a group (a bounded memory keeps them between groups and tasks). Whether
that holds is probed when the file is loaded (``drops_spaces``); for any other tokenizer whole texts are encoded. Where the file's normalizer
and pre-tokenizer are ``APART``, a word of letters with punctuation behind it is the letters' ids and then the
punctuation's, and letters go to the file's model in lines without marks (``Letters``).

Scale: one shuffle of the texts; a task holds one group (``group_ids`` words or ids, or one document) at a time. The running
starts need one row a file.

Defined cases: a null or empty text has only the end id. Documents without id come first; documents of equal id are
ordered by a hash of their text, then the text. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import json
import math
import os
import re
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textsift.llm import idcoder
from textsift.llm.common import SPACES, saved, scratch

MAGIC = b"TSID"
HEAD = struct.Struct("<4scII")
WORDS_KEPT = 1 << 19  # some 100 MB
WORDS_A_LINE = 200
MARKS = "~|^`"
LETTERS_KEPT = 1 << 20  # some 40 MB
DOCS_AT_ONCE = 100
BLOCKS_AT_ONCE = 4096
MEAN_WORD = 7  # bytes of a word and the space behind it, rather more than less


# One or two characters of every kind that normalisers and pre-tokenizers tell apart.
PROBES = ["a", "Z", "7", "'", "'s", "#", "_", ".", "\u00e9", "\u0301", "\u65e5", "\U0001F600", "<", "\u00a0"]
GAPS = [*SPACES, "  ", " \n", "\r\n"]


def drops_spaces(tokenizer) -> bool:
    """Whether a text's tokens are those of its words: no added token touches white space, and before tokens are looked up
    a text falls into the pieces of its words, whatever stands on either side of the white space."""
    before = tokenizer.pre_tokenizer
    if before is None or tokenizer.truncation or tokenizer.padding:
        return False
    if any(t.lstrip or t.rstrip or t.single_word or set(t.content) & set(SPACES) for t in tokenizer.get_added_tokens_decoder().values()):
        return False
    form = tokenizer.normalizer.normalize_str if tokenizer.normalizer else str
    pieces = lambda text: [p for p, _ in before.pre_tokenize_str(form(text))]
    alone = {p: pieces(p) for p in PROBES}
    return all(pieces(x + gap + y) == alone[x] + alone[y] for x in PROBES for y in PROBES for gap in GAPS) and not any(pieces(gap) for gap in GAPS)


#: Normalizer and pre-tokenizer under which words of letters and punctuation fall apart there only (as tokenizer files spell it).
APART = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]})
#: Letters that NFC keeps and that have one lower-case form of one character.
LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
LETTERS_MARKS = re.compile(f"(?:{LETTERS.pattern})?[{re.escape(string.punctuation)}]*")


class Letters:
    """Ids of runs of ``LETTERS`` (A-Z lower-cased) as little-endian u32, by the file's model after a pre-tokenizer that only cuts at
    spaces; null for other texts. A run ends with a token of the end-of-word suffix, so a line of runs is cut there. Those met last
    are kept in two Arrow arrays, a tenth of what a dict takes."""

    def __init__(self, tokenizer, form: dict):
        from tokenizers import Tokenizer, pre_tokenizers
        suffix, added = form["model"].get("end_of_word_suffix"), [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.known, self.coded, self.met, self.calls = pa.array([""]), pa.array([b""]), np.zeros(1, np.int64), 0
        self.usable = (form["normalizer"], form["pre_tokenizer"]) == APART and bool(suffix) and not form["model"].get("dropout") and not any(map(LETTERS_MARKS.fullmatch, added))
        if self.usable:
            self.bare = Tokenizer(tokenizer.model)
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            vocab = self.bare.get_vocab()
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    def ids(self, runs: pa.Array) -> pa.Array:
        """Of distinct runs."""
        self.calls += 1
        at = pc.index_in(runs, self.known)
        new = runs.filter(at.is_null())
        self.met[at.drop_null().to_numpy()] = self.calls
        self.met[0] = self.calls  # the empty run stays, and stays the first
        known, coded = pa.concat_arrays([self.known, new]), pa.concat_arrays([self.coded, self.encoded(listed(new))])
        self.met = np.concatenate([self.met, np.full(len(new), self.calls)])
        out = coded.take(pc.index_in(runs, known) if len(new) else at)
        if len(known) > LETTERS_KEPT:
            last = pa.array(np.sort(np.argsort(-self.met, kind="stable")[:LETTERS_KEPT * 3 // 4]))
            known, coded, self.met = known.take(last), coded.take(last), self.met[last.to_numpy()]
        self.known, self.coded = known, coded
        return out

    def encoded(self, runs: list[str]) -> pa.Array:
        got, good = dict.fromkeys(runs), [r for r in runs if LETTERS.fullmatch(r)]
        lines = [good[a:a + WORDS_A_LINE] for a in range(0, len(good), WORDS_A_LINE)]
        for a in range(0, len(lines), 100):
            for line, e in zip(lines[a:a + 100], self.bare.encode_batch_fast([" ".join(x).lower() for x in lines[a:a + 100]], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, "<u4")
                cuts = 4 * np.flatnonzero(self.ends[ids]) + 4
                if len(cuts) == len(line) and cuts[-1] == 4 * len(ids):
                    raw, at = ids.tobytes(), [0, *cuts.tolist()]
                    got.update((r, raw[at[k]:at[k + 1]]) for k, r in enumerate(line))
        return pa.array(got.values(), pa.binary())


class WordIds(dict):
    """Ids of a word as little-endian u32; words not known yet are encoded together.

    They are joined to lines, a mark of one id between them: a line costs about half of its words one by one. A line in which the
    mark's id isn't there as often as the mark is encoded by word."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores busy
        from tokenizers import Tokenizer
        self.tokenizer, self.before = Tokenizer.from_file(path), {}
        self.by_word = drops_spaces(self.tokenizer)
        self.mark = next(((m, ids[0]) for m in MARKS if len(ids := self.encode([m])[0]) == 1), None)
        with open(path, encoding="utf-8") as f:
            self.letters = Letters(self.tokenizer, json.load(f))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def add(self, words: set[bytes]) -> None:
        if len(self) > WORDS_KEPT // 2:  # words met since stay, those before go
            self.before = dict(self)
            self.clear()
        new = []
        for w in words - self.keys():
            if (ids := self.before.get(w)) is None:
                new.append(w)
            else:
                self[w] = ids
        lines = [new[a:a + WORDS_A_LINE] for a in range(0, len(new), WORDS_A_LINE)]
        if self.mark:
            gap = f" {self.mark[0]} ".encode()
            got = self.encode([gap.join(line).decode() for line in lines])
        for i, line in enumerate(lines):
            if self.mark:
                ids = np.array(got[i], "<u4")
                cuts = np.flatnonzero(ids == self.mark[1])
            if self.mark and len(cuts) == len(line) - 1:
                raw, at = ids.tobytes(), [-4, *(4 * cuts).tolist(), 4 * len(ids)]
                self.update((w, raw[at[k] + 4:at[k + 1]]) for k, w in enumerate(line))
            else:
                self.update((w, np.array(x, "<u4").tobytes()) for w, x in zip(line, self.encode([w.decode() for w in line]), strict=True))

    def texts(self, raw: list[bytes], end_id: int) -> list[bytes]:
        """Ids of whole texts, with the end id."""
        return [np.array([*ids, end_id], "<u4").tobytes() for ids in self.encode([t.decode() for t in raw])]

    def of_words(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words (an empty one has none)."""
        if not self.by_word or not self.letters.usable:
            raw = listed(words.cast(pa.binary()))
            self.add({w for w in raw if w})
            return pa.array([self[w] if w else b"" for w in raw], pa.binary())
        heads = pc.utf8_rtrim(words, characters=string.punctuation)
        size = pc.binary_length(heads).to_numpy()
        marked = np.flatnonzero(pc.binary_length(words).to_numpy() > size)
        tails = [w[n:] for w, n in zip(listed(words.take(pa.array(marked)).cast(pa.binary())), size[marked].tolist(), strict=True)]
        heads = pc.ascii_lower(heads).dictionary_encode()
        heads = self.letters.ids(heads.dictionary).take(heads.indices)
        other = np.flatnonzero(heads.is_null().to_numpy(zero_copy_only=False))
        whole = listed(words.take(pa.array(other)).cast(pa.binary()))
        self.add({*tails, *whole})
        behind = pa.DictionaryArray.from_arrays(*self.tails(marked, tails, len(words))).dictionary_decode()
        coded = pc.binary_join_element_wise(heads, behind, b"")
        return pc.replace_with_mask(coded, coded.is_null(), pa.array([self[w] for w in whole], pa.binary())) if len(whole) else coded

    def tails(self, marked: np.ndarray, tails: list[bytes], n: int) -> tuple[pa.Array, pa.Array]:
        """The ids of the punctuation behind ``n`` words as a dictionary's numbers and values; none but behind ``marked``."""
        number = {t: i for i, t in enumerate(dict.fromkeys(tails), 1)}
        at = np.zeros(n, np.int32)
        at[marked] = [number[t] for t in tails]
        return pa.array(at), pa.array([b"", *map(self.__getitem__, number)], pa.binary())

    def runs(self, texts: pa.ChunkedArray, end_id: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Runs of ids in texts (those of words, and the end id), the texts as numbers of runs, and how many each has."""
        lists = pc.ascii_split_whitespace(texts)  # at runs of \x20 and \x09-\x0D
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        found = pc.list_flatten(lists).dictionary_encode().combine_chunks()
        del lists
        coded = self.of_words(found.dictionary).dictionary_encode()
        runs = pa.concat_arrays([coded.dictionary, pa.array([struct.pack("<I", end_id)], pa.binary())])
        number = coded.indices.to_numpy().take(found.indices.to_numpy())
        # a word may have no ids
        some = (pc.binary_length(coded.dictionary).to_numpy() > 0).take(number)
        ends -= np.searchsorted(np.flatnonzero(~some), ends)
        return runs, np.insert(number[some], ends, len(runs) - 1), np.diff(ends, prepend=0) + 1


@functools.lru_cache(maxsize=1)
def _loaded(path: str, _changed: tuple[int, int]) -> WordIds:
    return WordIds(path)


def word_ids(path: str) -> WordIds:
    """The tokenizer file's word ids, kept by a Python worker from task to task until the file changes."""
    at = os.stat(path)
    return _loaded(path, (at.st_mtime_ns, at.st_size))


# --- frames --------------------------------------------------------------------------------------------------------

def frame(kind: bytes, payload: bytes) -> bytes:
    """A frame without its line feed."""
    return HEAD.pack(MAGIC, kind, len(payload), zlib.crc32(kind + payload)) + payload


def frames(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(kind, payload) in order; ValueError where the bytes aren't a frame or a checksum fails."""
    at = 0
    while at < len(data):
        magic, kind, size, crc = HEAD.unpack_from(data, at)
        payload = data[at + HEAD.size:at + HEAD.size + size]
        if magic != MAGIC or len(payload) != size or zlib.crc32(kind + payload) != crc or data[at + HEAD.size + size:at + HEAD.size + size + 1] != b"\n":
            raise ValueError(f"no whole frame at byte {at}")
        yield kind, payload
        at += HEAD.size + size + 1


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers, each of as few bytes as the array's largest needs, compressed."""
    out = []
    for a in arrays:
        width = next(w for w in (1, 2, 4) if int(a.max(initial=0)) < 1 << 8 * w)
        raw = a.astype(f"<u{width}").tobytes()
        packed = pa.compress(raw, "zstd", asbytes=True)
        out.append(struct.pack("<BII", width, len(a), len(packed)) + packed)
    return b"".join(out)


def unpack(data: bytes) -> Iterator[np.ndarray]:
    at = 0
    while at < len(data):
        width, n, size = struct.unpack_from("<BII", data, at)
        at += 9 + size
        yield np.frombuffer(pa.decompress(data[at - size:at], width * n, "zstd"), f"<u{width}")


def listed(a: pa.Array) -> list:
    """The values of an array without nulls; ``to_pylist`` is several times slower."""
    return a.to_numpy(zero_copy_only=False).tolist()


def joined(a: pa.Array) -> np.ndarray:
    """All ids of an array of ids as little-endian u32."""
    begin, end = np.frombuffer(a.buffers()[1], "<i4")[[a.offset, a.offset + len(a)]].tolist() if len(a) else (0, 0)
    return np.frombuffer(a.buffers()[2] or b"", "<u4", (end - begin) // 4, begin)


def write_runs(part: int, number: int, doc_ids: list[int | None], runs: pa.Array, stream: np.ndarray, n: np.ndarray, block_ids: int) -> Iterator[bytes]:
    """Frames of a group of documents: ``n`` run numbers of each in ``stream``."""
    ids = np.array([i or 0 for i in doc_ids], "<i8")
    flags = np.array([i is not None for i in doc_ids], "u1")
    yield frame(b"D", struct.pack("<III", part, number, len(doc_ids)) + ids.tobytes() + flags.tobytes() + n.astype("<u4").tobytes())
    # frequent runs have low numbers, rare ones the order in which they are met: a block's alphabet has small gaps
    order = np.argsort(-np.bincount(stream, minlength=len(runs)), kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    stream, runs = rank[stream], runs.take(pa.array(order))
    yield frame(b"R", pack(pc.binary_length(runs).to_numpy() // 4, joined(runs)))
    # enough blocks to code many in lockstep, of at least 1024 numbers
    size = min(block_ids, max(1024, -(-len(stream) // 2048)))
    blocks = np.array_split(stream, -(-len(stream) // size))
    coded = [c for a in range(0, len(blocks), BLOCKS_AT_ONCE) for c in idcoder.encode(blocks[a:a + BLOCKS_AT_ONCE])]
    yield frame(b"A", pack(np.array([len(a) for a, _ in coded]), np.frombuffer(b"".join(a for a, _ in coded), "u1")))
    for block, (_, code) in zip(blocks, coded, strict=True):
        yield frame(b"B", struct.pack("<II", len(block), zlib.crc32(block.tobytes())) + code)


def write_group(part: int, number: int, doc_ids: list[int | None], coded: list[bytes], block_ids: int) -> Iterator[bytes]:
    """Frames of a group of documents given as ids: every run is one id."""
    known, stream = np.unique(np.frombuffer(b"".join(coded), "<u4"), return_inverse=True)
    runs = pa.array([k.tobytes() for k in known], pa.binary())
    return write_runs(part, number, doc_ids, runs, stream, np.array([len(c) // 4 for c in coded]), block_ids)


def read_groups(data: bytes) -> Iterator[tuple[int, int, list[int | None], list[np.ndarray]]]:
    """(part, number, document ids, ids of each document) of the groups of a file."""
    group, blocks = None, []

    def done():
        part, number, docs, n = group
        lengths, alphabets = [b[0] for b in blocks], []
        sizes, raw = unpack(alphabet)
        raw, at = raw.tobytes(), 0
        for k in sizes.tolist():
            alphabets.append(raw[at:at + k])
            at += k
        coded = list(zip(alphabets, [b[2] for b in blocks], strict=True))
        got = [x for a in range(0, len(coded), BLOCKS_AT_ONCE) for x in idcoder.decode(coded[a:a + BLOCKS_AT_ONCE], lengths[a:a + BLOCKS_AT_ONCE])]
        for x, b in zip(got, blocks, strict=True):
            if zlib.crc32(x.astype("<u4").tobytes()) != b[1]:
                raise ValueError("a block's numbers fail its checksum")
        size, ids = unpack(runs)
        size, ids, got = size.astype(np.int64), ids.astype("<u4"), np.concatenate(got)
        begin, out, ends = np.cumsum(size) - size, [], np.cumsum(n)
        for a in range(0, len(n), DOCS_AT_ONCE):
            of = got[ends[a] - n[a]:ends[min(a + DOCS_AT_ONCE, len(n)) - 1]]
            long = size[of]
            upto = np.cumsum(long)
            found = ids[np.repeat(begin[of] - (upto - long), long) + np.arange(upto[-1] if len(of) else 0)]
            cuts = np.concatenate([[0], upto])[ends[a:a + DOCS_AT_ONCE] - (ends[a] - n[a])]
            out.extend(np.split(found, cuts[:-1]))
        return part, number, docs, out
    for kind, payload in frames(data):
        if kind == b"D":
            if group:
                yield done()
            part, number, k = struct.unpack_from("<III", payload)
            ids = np.frombuffer(payload, "<i8", k, 12)
            flags = np.frombuffer(payload, "u1", k, 12 + 8 * k)
            group, blocks = (part, number, [int(i) if f else None for i, f in zip(ids, flags, strict=True)], np.frombuffer(payload, "<u4", k, 12 + 9 * k).astype(np.int64)), []
        elif kind == b"R":
            runs = payload
        elif kind == b"A":
            alphabet = payload
        else:
            blocks.append((*struct.unpack_from("<II", payload), payload[8:]))
    if group:
        yield done()


# --- Spark ---------------------------------------------------------------------------------------------------------

def write_tokens(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2,
                 block_ids: int = 2048, file_bytes: int = 24 << 20, group_ids: int = 2_000_000) -> None:
    """Tokenise ``docs`` and write them below ``path`` in ascending order of id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, words, held, size = TaskContext.get().partitionId(), 0, word_ids(tokenizer), ([], []), 0

        def made() -> pa.RecordBatch:
            ids, texts = held[0].copy(), held[1].copy()
            held[0].clear()
            held[1].clear()
            if words.by_word:
                split = words.runs(pa.chunked_array(texts, pa.string()), end_id)
                texts.clear()
                group = write_runs(part, number, ids, *split, block_ids)
            else:
                group = write_group(part, number, ids, texts, block_ids)
            return pa.RecordBatch.from_arrays([pa.array(list(group), pa.binary())], ["frame"])
        for b in batches:
            for a in range(0, b.num_rows, DOCS_AT_ONCE):
                piece = b.slice(a, DOCS_AT_ONCE)
                held[0].extend(piece.column(0).to_pylist())
                if words.by_word:
                    text = piece.column(1).cast(pa.string())
                    held[1].append(text)
                    size += len(text) + pc.sum(pc.binary_length(text)).as_py() // MEAN_WORD
                else:
                    coded = words.texts(piece.column(1).to_pylist(), end_id)
                    held[1].extend(coded)
                    size += sum(map(len, coded)) // 4
                if size >= group_ids:
                    yield made()
                    number, size = number + 1, 0
        if held[0]:
            yield made()
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    rows = rows.withColumn("h", F.xxhash64("t"))
    rows = rows.repartitionByRange(max(1, math.ceil(total / file_bytes)), "doc_id", "h").sortWithinPartitions("doc_id", "h", "t").select("doc_id", "t")
    rows.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """(part, number, at, doc_id, n_tokens, ids_crc32, ids) of every document; ``at``: ids of the group before it. ``ids`` are null
    if not wanted."""
    names = ["part", "number", "at", "doc_id", "n_tokens", "ids_crc32", "ids"]
    schema = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("at", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                for part, number, docs, ids in read_groups(content.as_buffer().to_pybytes()):
                    at = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                    for a in range(0, len(docs), 1000):
                        raw = [x.astype("<u4").tobytes() for x in ids[a:a + 1000]]
                        columns = [[part] * len(raw), [number] * len(raw), at[a:a + len(raw)].tolist(), docs[a:a + 1000], [len(x) // 4 for x in raw], [zlib.crc32(x) for x in raw], raw if with_ids else [None] * len(raw)]
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], names)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "part int, number int, at bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint, ids binary")


def token_positions(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the store into the shared folder, read it back: (doc_id, start, n_tokens, ids_crc32) of each document."""
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    write_tokens(docs, path, tokenizer, **options)
    rows = saved(read_tokens(spark, path, with_ids=False).drop("ids"), "positions")
    # a row for each group of ids, some for each file
    groups = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1))
    groups = groups.select("part", "number", F.coalesce(before, F.lit(0).cast("bigint")).alias("before"))
    return rows.join(groups, ["part", "number"]).select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
