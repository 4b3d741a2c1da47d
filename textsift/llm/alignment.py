"""Cross-tokenizer alignment with external spill counting (operator 11).

Every text is encoded by a byte-level BPE (A) and a sentence-piece model (B). Where tokens of both end at the same byte a
group ends, and the last tokens of the group are linked. How often an id pair is linked in the corpus is counted outside memory:

1. Tasks write the links as records (pair, document, multiplicity), sorted B-major, radix-partitioned by the low digits of the B id into
   zstd-compressed runs; a run is a sequence of frames, in pieces of at most ``PIECE`` records.
2. A k-way heap merge of the runs of a part counts its pairs. A bucket of the radix gets as many parts as its pieces
   need, so a B id with a third of all links is split; the parts' counts (at most one row a pair) are added by Spark.
3. In B-major order the highest count of each B id is a window over its pairs.
4. The runs are read once more, part by part, against the counts of their bucket, and what each piece adds to its
   documents streams back: packed by run first, then by document.

Encoding: a text is cut before every space that follows a character other than white space. Neither tokenizer has a token
across such a cut (checked when the files are loaded; else texts are encoded whole), and tokens of both end there, so a
text's tokens and groups are those of its segments one after another. Equal segments are encoded once while a task
remembers them, many at a time. The byte-level BPE runs in tiktoken with the vocabulary of the tokenizers file as ranks,
if the merges are in the order of their ids (else in the tokenizers library).

Scale: texts are never shuffled; a task holds ``RUN`` records, or a document's. Tasks of steps 2 and 4 hold a frame of
each run, and the pairs of one bucket (bounded by the vocabularies).

Defined cases: a null or empty text, or one whose tokens' bytes aren't a space and the text, has no tokens. Documents
that share an id are documents of their own. A null id stays null. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textsift.llm.common import saved, shuffle_partitions

TEXT_AT_ONCE = 1 << 20  # bytes of text handled together
ENCODED_AT_ONCE = 1 << 16  # characters encoded together
KEPT = 300_000  # segments a task remembers
RUN = 1_500_000  # records sorted together
PIECE = 100_000  # records of a row
FRAME = 8192  # keys of a frame
FAN_IN = 32  # runs merged together
BUCKETS = 32  # of the radix

#: White space of Unicode, and all of it but the space.
OTHER_SPACE = "\t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SEGMENT = re.compile(f" [ {OTHER_SPACE}]*+(?:[^ {OTHER_SPACE}]++(?:[{OTHER_SPACE}][ {OTHER_SPACE}]*+)?+)*+")
_IRREGULAR = re.compile(f"[ {OTHER_SPACE}] ")
_ENDS_IN_SPACE = re.compile(rf"[ {OTHER_SPACE}]\Z")


# --- tokenizers ----------------------------------------------------------------------------------------------------

def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    return out | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}


class ByteLevel:
    """Tokenizer A from a file of the tokenizers library; ``bytes_of[id]``."""

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores busy
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters, pre = spec["model"]["vocab"], byte_alphabet(), spec["pre_tokenizer"]
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
        self.size = 1 + max(vocab.values())
        self.bytes_of = [b""] * self.size
        for b, i in ranks.items():
            self.bytes_of[i] = b
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        made = [vocab["".join(p)] for p in pairs]
        plain = spec["normalizer"] is None and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
        # the pattern of such files cuts before a space that follows a character other than white space
        self.cuts_at_spaces = plain
        if plain and all(a < b for a, b in zip(made, made[1:])) and len(ranks) == 256 + len(made):
            import tiktoken
            self.encode = tiktoken.Encoding("byte_level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}, explicit_n_vocab=None).encode_ordinary
        else:
            from tokenizers import Tokenizer
            own = Tokenizer.from_file(path)
            own.encode_special_tokens = True
            self.encode = lambda text: own.encode(text, add_special_tokens=False).ids


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = raw[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out
    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield key >> 3, raw[at:at + size]
            at += size


class Pieces:
    """Tokenizer B from a sentence-piece model; ``bytes_of[id]``."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        with open(path, "rb") as f:
            normal = dict(fields(dict(x for x in fields(f.read()) if x[0] == 3).get(3, b"")))
        # no rewriting of texts (2: character map, 3: space in front, 4: runs of spaces), no piece with a space after another character
        self.cuts_at_spaces = not normal.get(2) and normal.get(3, 1) == 1 and normal.get(4, 1) == 0 and not any(re.search("[^▁]▁", p) for p in pieces)
        self.space = self.model.piece_to_id("▁")

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with a space, which stands for the one that the model puts in front."""
        got = self.model.encode([t[1:] for t in texts], num_threads=1)
        return [[self.space] if t == " " else ids for t, ids in zip(texts, got, strict=True)]


# --- segments --------------------------------------------------------------------------------------------------------

def segments(text: str) -> list[str]:
    """A space and the text, cut before every space that follows a character other than white space; the leading space of each is left out."""
    whole = " " + text
    return text.split(" ") if not _IRREGULAR.search(whole) else [s[1:] for s in _SEGMENT.findall(whole)]


class Aligner:
    """Groups and links of segments, remembered while there is room."""

    def __init__(self, a_path: str, b_path: str, pattern: str):
        self.a, self.b = ByteLevel(a_path, pattern), Pieces(b_path)
        if self.a.size * self.b.size >= 1 << 32:
            raise ValueError("the vocabularies have too many pairs for 32 bits")
        self.cuts = self.a.cuts_at_spaces and self.b.cuts_at_spaces
        self.a_len, self.b_len = (np.array([len(x) for x in t.bytes_of], np.int64) for t in (self.a, self.b))
        # an id and the mark after it: A inside a group, A at its end, B inside, B at its end
        self.shown = [f"{i}{end}".encode() for size, ends in ((self.a.size, ",|"), (self.b.size, ",;")) for i in range(size) for end in ends]
        self.shown_len = np.array([len(x) for x in self.shown], np.int64)
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.texts: list[bytes] = []  # groups as text, ending in ;
        self.counts = np.zeros((1024, 4), np.int64)  # A tokens, B tokens, groups, usable
        self.starts = np.zeros(1025, np.int64)  # of the segment's links
        self.links = np.zeros(4096, np.uint32)

    def add(self, new: list[str]) -> None:
        """Remember segments that aren't known."""
        pending: list[str] = []
        size = 0
        alone = []
        for s in new:
            if len(s) > ENCODED_AT_ONCE or not s or _ENDS_IN_SPACE.search(s):  # nothing may follow these
                alone.append(s)
                continue
            pending.append(s)
            size += len(s) + 1
            if size > ENCODED_AT_ONCE:
                self._add(pending)
                pending, size = [], 0
        if pending:
            self._add(pending)
        for s in alone:
            self._add([s])

    def _add(self, some: list[str]) -> None:
        raw = [b" " + s.encode() for s in some]
        whole = b"".join(raw)
        text = whole.decode()
        a = self.a.encode(text)
        b = self.b.encode_all([text])[0]
        if b"".join(map(self.a.bytes_of.__getitem__, a)) != whole or b"".join(map(self.b.bytes_of.__getitem__, b)) != whole:
            if len(some) > 1:
                for s in some:
                    self._add([s])
            else:
                self._keep(some, [b""], np.zeros((1, 4), np.int64), np.zeros(0, np.uint32))
            return
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        here = np.zeros((2, len(whole) + 1), bool)
        here[0, a_end] = here[1, b_end] = True
        a_last, b_last = here[1, a_end], here[0, b_end]
        a_cut, b_cut = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1  # ends of the groups in tokens
        group_end = a_end[a_cut - 1]
        bounds = np.cumsum([len(x) for x in raw])
        groups = np.searchsorted(group_end, bounds, "right")  # groups up to each segment's end
        if not np.array_equal(group_end[groups - 1], bounds):
            raise AssertionError("a token spans a cut between segments")
        # the marks in order: a group's A tokens, then its B tokens
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.concatenate([[0], b_cut])[np.cumsum(a_last) - a_last]] = 2 * a + a_last
        order[np.arange(len(b)) + a_cut[np.cumsum(b_last) - b_last]] = 2 * (self.a.size + b) + b_last
        shown = b"".join(map(self.shown.__getitem__, order.tolist()))
        at = np.cumsum(self.shown_len[order])[a_cut[groups - 1] + b_cut[groups - 1] - 1].tolist()
        texts = [shown[x:y] for x, y in zip([0, *at], at)]
        n = np.stack([a_cut[groups - 1], b_cut[groups - 1], groups], axis=1)
        counts = np.concatenate([np.diff(n, axis=0, prepend=0), np.ones((len(some), 1), np.int64)], axis=1)
        self._keep(some, texts, counts, (b[b_cut - 1] * self.a.size + a[a_cut - 1]).astype(np.uint32))

    def _keep(self, some: list[str], texts: list[bytes], counts: np.ndarray, links: np.ndarray) -> None:
        first, end = len(self.texts), len(self.texts) + len(some)
        if end > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros((end, 4), np.int64)])
            self.starts = np.concatenate([self.starts, np.zeros(len(self.counts) + 1 - len(self.starts), np.int64)])
        used = int(self.starts[first])
        if used + len(links) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros(used + len(links), np.uint32)])
        self.counts[first:end] = counts
        self.starts[first + 1:end + 1] = used + np.cumsum(counts[:, 2])
        self.links[used:used + len(links)] = links
        self.texts.extend(texts)
        self.known.update(zip(some, range(first, end)))

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Of documents that aren't empty: rows of (A tokens, B tokens, groups), digests, and their links with the documents' positions."""
        if len(self.known) > KEPT:
            self.clear()
        cut = [segments(t) if self.cuts else [t] for t in texts]
        self.add([s for s in dict.fromkeys(s for c in cut for s in c) if s not in self.known])
        sizes = np.array([len(c) for c in cut], np.int64)
        at = np.fromiter((self.known[s] for c in cut for s in c), np.int64, int(sizes.sum()))
        sums = np.add.reduceat(self.counts[at], np.cumsum(sizes) - sizes, axis=0)
        usable = sums[:, 3] == sizes
        lists = at.tolist()
        digests, first = [], 0
        for n, ok in zip(sizes.tolist(), usable.tolist(), strict=True):
            digests.append(hashlib.sha256(b"".join([self.texts[i] for i in lists[first:first + n]])[:-1]).hexdigest() if ok else "")
            first += n
        sums *= usable[:, None]
        at = at[np.repeat(usable, sizes)]
        n = self.counts[at, 2]
        flat = np.repeat(self.starts[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return sums[:, :3], digests, self.links[flat], np.repeat(np.arange(len(texts)), sums[:, 2])


# --- runs --------------------------------------------------------------------------------------------------------------

def packed(*columns: np.ndarray) -> bytes:
    """A frame: sizes, then the columns, zstd-compressed; sorted columns should be differences."""
    import zstandard
    body = b"".join(np.ascontiguousarray(c).tobytes() for c in columns)
    data = zstandard.ZstdCompressor(level=1).compress(body)
    return struct.pack("<I", len(data)) + struct.pack(f"<B{len(columns)}I", len(columns), *map(len, columns)) + data


def unpacked(raw: bytes, dtypes: tuple[str, ...]) -> Iterator[list[np.ndarray]]:
    """Frames of ``packed``, one at a time."""
    import zstandard
    at, k = 0, len(dtypes)
    while at < len(raw):
        size, = struct.unpack_from("<I", raw, at)
        _, *n = struct.unpack_from(f"<B{k}I", raw, at + 4)
        at += 5 + 4 * k
        body = zstandard.ZstdDecompressor().decompress(raw[at:at + size])
        at += size
        out, used = [], 0
        for count, d in zip(n, dtypes, strict=True):
            out.append(np.frombuffer(body, d, count, used))
            used += out[-1].nbytes
        yield out


def pieces(records: np.ndarray, a_size: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(bucket, records, keys, body) of a run: records are pair << 32 | document, in any order, with repeats."""
    records.sort()
    first = np.flatnonzero(np.concatenate([[True], records[1:] != records[:-1]]))
    times = np.diff(np.append(first, len(records))).astype("<u4")
    key, doc = (records[first] >> np.uint64(32)).astype(np.uint32), records[first].astype(np.uint32)
    bucket = (key // np.uint32(a_size) % np.uint32(BUCKETS)).astype(np.uint8)
    order = np.argsort(bucket, kind="stable")
    bucket, key, doc, times = bucket[order], key[order], doc[order], times[order]
    for k, (x, y) in enumerate(zip(np.searchsorted(bucket, np.arange(BUCKETS), "left"), np.searchsorted(bucket, np.arange(BUCKETS), "right"), strict=True)):
        for s in range(x, y, PIECE):
            e = min(s + PIECE, y)
            start = np.flatnonzero(np.concatenate([[True], key[s + 1:e] != key[s:e - 1]]))
            own = key[s:e][start].astype("<u4")
            docs_of = np.diff(np.append(start, e - s)).astype("<u4")
            n = np.add.reduceat(times[s:e].astype("<i8"), start)
            keys = b"".join(packed(np.diff(own[i:i + FRAME], prepend=own.dtype.type(0)), n[i:i + FRAME]) for i in range(0, len(own), FRAME))
            body = packed(np.diff(own, prepend=own.dtype.type(0)), docs_of, np.diff(doc[s:e].astype("<u4"), prepend=np.uint32(0)), times[s:e])
            yield k, e - s, keys, body


def frames_of(raw: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, counts) frames of a run's piece."""
    for delta, n in unpacked(raw, ("<u4", "<i8")):
        yield np.cumsum(delta, dtype=np.uint32), n


def merged(runs: list[Iterator[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """k-way merge of sorted runs of (keys, counts) frames; equal keys are added up. Holds a frame of each run.

    The heap has the last key of each run's frame: up to the smallest of these no run has a key in a later frame.
    """
    if len(runs) > FAN_IN:
        runs = [merged(runs[i:i + FAN_IN]) for i in range(0, len(runs), FAN_IN)]
        yield from merged(runs)
        return
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def load(i: int) -> None:
        if (frame := next(runs[i], None)) is not None:
            held[i] = frame
            heapq.heappush(heap, (int(frame[0][-1]), i))
    for i in range(len(runs)):
        load(i)
    rest: tuple[np.ndarray, np.ndarray] | None = None  # the last key may go on in the next frames
    while heap:
        bound, ended = heap[0][0], []
        while heap and heap[0][0] == bound:
            ended.append(heapq.heappop(heap)[1])
        parts = [rest] if rest else []
        for i, (k, n) in list(held.items()):
            if (cut := int(np.searchsorted(k, bound, "right"))):
                parts.append((k[:cut], n[:cut]))
                held[i] = (k[cut:], n[cut:])
        for i in ended:
            del held[i]
            load(i)
        keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[first], np.add.reduceat(counts, first)
        if len(keys) > 1:
            yield keys[:-1], counts[:-1]
        rest = keys[-1:], counts[-1:]
    if rest:
        yield rest


# --- Spark -------------------------------------------------------------------------------------------------------------

TOKENS = "pid int, run int, seq bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, bucket int, piece int, keys binary, body binary"
_TOKENS = pa.schema([("pid", pa.int32()), ("run", pa.int32()), ("seq", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                     ("groups_sha256", pa.string()), ("bucket", pa.int32()), ("piece", pa.int32()), ("keys", pa.binary()), ("body", pa.binary())])


def _rows(n: int, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _TOKENS], schema=_TOKENS)


def _encoder(a_path: str, b_path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, pid, number, seq = Aligner(a_path, b_path, pattern), TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        size = 0

        def documents(ids: list, texts: list[str | None]) -> pa.RecordBatch:
            nonlocal seq, size
            full = [i for i, t in enumerate(texts) if t]
            counts, digests = np.zeros((len(texts), 3), np.int64), [""] * len(texts)
            if full:
                sums, shown, links, of = aligner.align([texts[i] for i in full])
                counts[full] = sums
                for i, x in zip(full, shown, strict=True):
                    digests[i] = x
                held.append(links.astype(np.uint64) << np.uint64(32) | (np.array(full, np.uint64)[of] + np.uint64(seq)))
                size += len(links)
            out = {"pid": [pid] * len(ids), "run": [number] * len(ids), "seq": list(range(seq, seq + len(ids))), "doc_id": ids, "n_a": counts[:, 0], "n_b": counts[:, 1], "n_groups": counts[:, 2], "groups_sha256": digests}
            seq += len(ids)
            return _rows(len(ids), out)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, size
            if size:
                records = np.concatenate(held)
                held.clear()
                for piece, (bucket, _, keys, body) in enumerate(pieces(records, aligner.a.size)):
                    yield _rows(1, {"pid": [pid], "run": [number], "bucket": [bucket], "piece": [piece], "keys": [keys], "body": [body]})
            number, size = number + 1, 0
        for b in batches:
            ids, texts, taken = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = t.as_py()
                ids.append(i)
                texts.append(text)
                taken += len(text or "")
                if taken >= TEXT_AT_ONCE:
                    yield documents(ids, texts)
                    ids, texts, taken = [], [], 0
                    if size >= RUN:
                        yield from flush()
            if ids:
                yield documents(ids, texts)
        yield from flush()
    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, keys) sorted by part -> (pair, n) of each part."""
    def count(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        for keys, n in merged([frames_of(x) for x in blobs]):
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])
    part, held = None, []
    for b in batches:
        for p, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            if p != part and held:
                yield from count(held)
                held = []
            part = p
            held.append(raw.as_py())
    if held:
        yield from count(held)


def _contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, kind): a part's pairs with their counts, then its pieces -> what each piece adds to its documents."""
    part, held, table = None, [], None
    for b in batches:
        parts = b.column(0).to_numpy()
        cuts = np.flatnonzero(np.diff(parts)) + 1
        for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
            if parts[x] != part:
                part, held, table = parts[x], [], None
            some = b.slice(x, y - x)
            n_pairs = int((some.column(1).to_numpy() == 0).sum())
            if n_pairs:
                held.append([some.column(i).slice(0, n_pairs).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3, 4)])
            for i in range(n_pairs, y - x):
                if table is None:
                    table = [np.concatenate(c) for c in zip(*held)]  # sorted by pair
                    held = []
                (delta, docs_of, docs, times), = unpacked(some.column(7)[i].as_py(), ("<u4", "<u4", "<u4", "<u4"))
                at = np.repeat(np.searchsorted(table[0], np.cumsum(delta, dtype=np.uint32).astype(np.int64)), docs_of)
                docs, times = np.cumsum(docs, dtype=np.uint32), times.astype(np.int64)
                first = int(docs.min())
                best, total = np.zeros(int(docs.max()) - first + 1, np.int64), np.zeros(int(docs.max()) - first + 1, np.int64)
                np.add.at(best, docs - np.uint32(first), times * table[2][at])
                np.add.at(total, docs - np.uint32(first), times * table[1][at])
                seen = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array([some.column(5)[i].as_py()], pa.int32()), pa.array([some.column(6)[i].as_py()], pa.int32()),
                                                  pa.array([packed((seen + first).astype("<u4"), best[seen], total[seen])], pa.binary())], ["pid", "run", "gained"])


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (pid, run, gained) sorted by (pid, run) -> (pid, seq, n_best, count_sum): a document's links are all in one run."""
    def out(pid: int, gained: list[bytes]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*(f for raw in gained for f in unpacked(raw, ("<u4", "<i8", "<i8"))))]
        seq, at = np.unique(columns[0], return_inverse=True)
        sums = np.zeros((2, len(seq)), np.int64)
        np.add.at(sums[0], at, columns[1])
        np.add.at(sums[1], at, columns[2])
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(seq), pid), pa.int32()), pa.array(seq, pa.int64()), pa.array(sums[0]), pa.array(sums[1])], ["pid", "seq", "n_best", "count_sum"])
    key, held = None, []
    for b in batches:
        for pid, run, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if key != (pid, run) and held:
                yield out(key[0], held)
                held = []
            key = (pid, run)
            held.append(raw)
    if held:
        yield out(key[0], held)


def align(docs: DataFrame, a_path: str, b_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document; see the contract of op11.

    ``pattern``: the one that the byte-level tokenizer cuts texts by."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    made = saved(rows.mapInArrow(_encoder(a_path, b_path, pattern), TOKENS), "tokens")
    a_size = len(ByteLevel(a_path, pattern).bytes_of)

    # parts of the buckets by their pieces: more of them for a bucket with a hot id
    runs = made.where(F.col("bucket").isNotNull())
    sizes = {r["bucket"]: r["n"] for r in runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most BUCKETS rows
    width = min(2048, max(32, sum(sizes.values()) // (4 * shuffle_partitions(spark))))
    parts = {k: math.ceil(n / width) for k, n in sizes.items()} or {0: 1}
    starts = dict(zip(sorted(parts), np.cumsum([0, *(parts[k] for k in sorted(parts))]).tolist()))
    lookup = lambda values, key: F.element_at(F.create_map(*[F.lit(int(x)) for kv in values.items() for x in kv]), key)
    part = (lookup(starts, F.col("bucket")) + F.pmod(F.xxhash64("pid", "run", "piece"), lookup(parts, F.col("bucket"))).cast("int")).alias("part")

    counts = runs.select(part, "keys").repartition("part").sortWithinPartitions("part").mapInArrow(_count, "pair bigint, n bigint")
    counts = counts.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", (F.col("pair") / a_size).cast("int"))
    best = F.max("n").over(Window.partitionBy("b"))
    counts = counts.select("pair", "n", (F.col("n") == best).cast("int").alias("best"), (F.col("b") % BUCKETS).alias("bucket"))
    counts = saved(counts, "counts")

    every = counts.select(F.explode(F.sequence(lookup(starts, F.col("bucket")), lookup(starts, F.col("bucket")) + lookup(parts, F.col("bucket")) - 1)).alias("part"), F.lit(0).alias("kind"), "pair", "n", "best",
                          F.lit(None).cast("int").alias("pid"), F.lit(None).cast("int").alias("run"), F.lit(None).cast("binary").alias("body"))
    blobs = runs.select(part, F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("pair"), F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("int").alias("best"), "pid", "run", "body")
    gained = every.unionByName(blobs).repartition("part").sortWithinPartitions("part", "kind", "pair").mapInArrow(_contribute, "pid int, run int, gained binary")
    sums = gained.repartition("pid", "run").sortWithinPartitions("pid", "run").mapInArrow(_add_up, "pid int, seq bigint, n_best bigint, count_sum bigint")

    one = made.where(F.col("bucket").isNull()).join(sums, ["pid", "seq"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return one.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256")
