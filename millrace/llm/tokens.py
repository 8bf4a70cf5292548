"""Token ids in flat binary files.

A document becomes ids of a public tokenizer and an end id. Documents are range-partitioned by id; each task appends the
ids of its documents to one flat file of unsigned integers and writes their 64-bit offsets beside it. Where a file's
ids stand among all ids, its base, is the sum of the files before it, known once all are written. Files can be mapped
into memory, and any range of ids found by base and offset.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import batch_of, range_tasks, releasing, worker_state
from millrace.session import working_path

END_ID = 0

# Different pieces whose ids a worker remembers; bytes of text that are cut into pieces at once.
CACHE_PIECES, CUT_BYTES = 500_000, 1 << 19

# New pieces are kept in a dictionary until there are so many, and then sorted in among the others.
_RECENT = 50_000

# Documents that one task writes, about.
DOCS_PER_FILE = 200_000

# Code points of a text that, after doc_id, decide its range; the driver samples so much of some texts.
RANGE_CHARS = 500

# Texts with other white space than ASCII's, or with separators that only some count as white space, are not cut.
_WHOLE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

_CUT = re.compile(rb"[^\t-\r ][\t-\r ]")

# Kinds of bytes.
_SPACE, _LETTER, _MARK = 1, 2, 4
_KINDS = np.zeros(256, np.uint8)
_KINDS[[9, 10, 11, 12, 13, 32]] = _SPACE
_KINDS[[*range(65, 91), *range(97, 123)]] = _LETTER
# Marks without the apostrophe, which can begin a piece with the letters after it.
_KINDS[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = _MARK


def piece_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where pieces begin in UTF-8 bytes, given where texts begin. A byte-level tokenizer first parts a text into words
    (letters with one blank before them), numbers, marks and white space, and joins ids only inside such a part. So a
    text can be cut before white space, after a single white space that is no blank, and between letters and marks."""
    kind = _KINDS[data]
    space, letter, mark = (kind & k > 0 for k in (_SPACE, _LETTER, _MARK))
    first = np.zeros(len(data), bool)
    first[texts] = True
    # C3 leads the letters from U+00C0 to U+00FF, but for the two signs at 97 and B7.
    wide = np.zeros(len(data), bool)
    wide[1:] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    start = first.copy()
    start[1:] |= space[1:] & ~space[:-1]
    start[1:] |= mark[1:] & (letter | wide)[:-1]
    start[1:] |= letter[1:] & mark[:-1]
    lone = space & (data != 32)
    lone[1:] &= ~space[:-1] | first[1:]
    start[1:] |= ~space[1:] & lone[:-1]
    return np.flatnonzero(start)


def _parts(text: bytes) -> Iterator[bytes]:
    """A very long text in parts of about CUT_BYTES, cut before white space."""
    at = 0
    while len(text) - at > CUT_BYTES and (cut := _CUT.search(text, at + CUT_BYTES)):
        yield text[at : cut.end() - 1]
        at = cut.end() - 1
    yield text[at:] if at else text


class Encoder:
    """Ids of whole texts by a byte-level tokenizer file of the tokenizers library.

    Texts are cut into pieces whose ids do not depend on what is around them. Each different piece is given to the
    library once and its ids are remembered under a 64-bit hash of its bytes. Texts with unusual white space or the name
    of a special token are given to the library whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        rng = np.random.default_rng(1)
        self.byte_values = rng.integers(1, 1 << 63, 256, np.uint64)
        base = 0x9E3779B97F4A7C15
        self.bases = base, pow(base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)
        self._forget()

    def _forget(self) -> None:
        # Hashes in ascending order and where their ids are; a dictionary would take ten times the memory.
        self.hashes, self.rows, self.recent, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int32), {}, 0
        self.begins, self.sizes = np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.int32)
        self.ids, self.used = np.zeros(1 << 14, np.uint32), 0

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Ids of each text, without special tokens added; a null text has none."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        at, group, size = [], [], 0
        for n, text in enumerate(texts):
            if not text:
                continue
            if _WHOLE.search(text) or any(s in text for s in self.special):
                out[n].append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
                continue
            for part in _parts(text.encode()):
                at.append(n)
                group.append(part)
                size += len(part)
                if size >= CUT_BYTES:
                    self._encode(group, at, out)
                    at, group, size = [], [], 0
        if group:
            self._encode(group, at, out)
        return [p[0] if len(p) == 1 else np.concatenate([np.zeros(0, np.uint32), *p]) for p in out]

    def _hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(data) + 1
        if n > len(self.powers):
            self.powers, self.inverses = (
                np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(n - 1, b, np.uint64))]) for b in self.bases)
        sums = np.zeros(n, np.uint64)
        np.cumsum(self.byte_values[data] * self.powers[: n - 1], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64)

    def _encode(self, group: list[bytes], at: list[int], out: list[list[np.ndarray]]) -> None:
        joined = b"".join(group)
        data = np.frombuffer(joined, np.uint8)
        texts = np.cumsum([0] + [len(t) for t in group])
        starts = piece_starts(data, texts[:-1])
        ends = np.append(starts[1:], len(data))
        kinds, first, which = np.unique(self._hashes(data, starts, ends), return_index=True, return_inverse=True)
        if self.count > CACHE_PIECES:
            self._forget()
        places = self._find(kinds)
        new = np.flatnonzero(places < 0)
        for i in range(0, len(new), 10_000):
            some = new[i : i + 10_000]
            pieces = [joined[a:b].decode() for a, b in zip(starts[first[some]].tolist(), ends[first[some]].tolist())]
            found = [f.ids for f in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
            places[some] = np.arange(self.count, self.count + len(some))
            self._keep(found)
            self.recent.update(zip(kinds[some].tolist(), places[some].tolist()))
        rows = places[which]
        begins, sizes = self.begins[rows].astype(np.int64), self.sizes[rows].astype(np.int64)
        upto = np.cumsum(sizes)
        ids = self.ids[np.repeat(begins - upto + sizes, sizes) + np.arange(upto[-1])]
        cuts = np.append(upto - sizes, upto[-1])[np.searchsorted(starts, texts)]
        for n, a, b in zip(at, cuts[:-1].tolist(), cuts[1:].tolist()):
            out[n].append(ids[a:b])

    def _find(self, kinds: np.ndarray) -> np.ndarray:
        """Place of each of these hashes (ascending), -1 for new ones."""
        if len(self.recent) > _RECENT:
            hashes = np.concatenate([self.hashes, np.fromiter(self.recent.keys(), np.uint64, len(self.recent))])
            rows = np.concatenate([self.rows, np.fromiter(self.recent.values(), np.int32, len(self.recent))])
            order = np.argsort(hashes, kind="stable")
            self.hashes, self.rows, self.recent = hashes[order], rows[order], {}
        places = np.full(len(kinds), -1, np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, kinds), len(self.hashes) - 1)
            same = self.hashes[at] == kinds
            places[same] = self.rows[at[same]]
        left = np.flatnonzero(places < 0)
        places[left] = [self.recent.get(h, -1) for h in kinds[left].tolist()]
        return places

    def _keep(self, found: list[list[int]]) -> None:
        place = self.count
        self.count += len(found)
        flat = np.fromiter(chain.from_iterable(found), np.uint32)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        while len(self.begins) < place + len(found):
            self.begins, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begins, self.sizes))
        while len(self.ids) < self.used + len(flat):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.begins[place : place + len(found)] = self.used + np.cumsum(sizes) - sizes
        self.sizes[place : place + len(found)] = sizes
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    held = worker_state("encoders", dict)
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def encoded(texts: pa.Array, tokenizer: str, at_once: int = 128) -> Iterator[np.ndarray]:
    """Ids of each text of a column, a few texts at a time, with the end id."""
    for i in range(0, len(texts), at_once):
        for ids in encoder(tokenizer).encode(texts[i : i + at_once].to_pylist()):
            yield np.append(ids, np.uint32(END_ID))


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


_SUMMARY = "part int, name string, docs bigint, tokens bigint"


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, dtype: str = "uint16", text: str = "text", doc_id: str = "doc_id"
) -> dict:
    """Write the ids of all documents in ascending order of doc_id (nulls first, ties by text) under `path`, a folder
    that all executors share, and return the manifest, which is written last. Batch; runs jobs.

    For each file `<name>` of the manifest there are `<name>.ids` (little-endian `dtype`), `<name>.offsets` (one more
    uint64 than documents: where each document begins in this file), `<name>.docs` (int64 doc_id) and `<name>.nulls`
    (a byte for each document, 1 where doc_id is null). Names hold the attempt that wrote them; files that the
    manifest does not name were left by lost attempts and mean nothing. Null and empty texts are an end id alone,
    repeated rows are written as often as they come, an empty table gives a manifest without files. `dtype` must hold
    every id; an id that does not fit is an error."""
    spark = docs.sparkSession
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    tasks = range_tasks(spark, docs.select(doc_id).count(), DOCS_PER_FILE)
    # Documents that share an id (or have none) are parted by their texts, in the same order as they are sorted.
    ordered = plain.repartitionByRange(tasks, "doc_id", F.substring("text", 1, RANGE_CHARS)).sortWithinPartitions("doc_id", "text")
    root = path.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, most = TaskContext.get(), np.iinfo(dtype).max
        name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}"
        disk, folder = _place(root)
        disk.create_dir(folder, recursive=True)
        count, tokens = 0, 0
        with (disk.open_output_stream(f"{folder}/{name}.ids") as ids_file,
              disk.open_output_stream(f"{folder}/{name}.offsets") as offsets_file,
              disk.open_output_stream(f"{folder}/{name}.docs") as docs_file,
              disk.open_output_stream(f"{folder}/{name}.nulls") as nulls_file):
            offsets_file.write(np.zeros(1, "<u8").tobytes())
            for batch in batches:
                lengths = []
                for ids in encoded(batch.column("text"), tokenizer):
                    if int(ids.max()) > most:
                        raise ValueError(f"id {ids.max()} does not fit {dtype}")
                    ids_file.write(ids.astype(np.dtype(dtype).newbyteorder("<")).tobytes())
                    lengths.append(len(ids))
                offsets_file.write((tokens + np.cumsum(lengths)).astype("<u8").tobytes())
                keys = batch.column("doc_id")
                docs_file.write(keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                nulls_file.write(keys.is_null().to_numpy(zero_copy_only=False).astype("u1").tobytes())
                count, tokens = count + len(lengths), tokens + sum(lengths)
        if count:
            yield batch_of([("part", pa.int32()), ("name", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())],
                           [[context.partitionId()], [name], [count], [tokens]])

    # One row for each file.
    files = sorted(tuple(r) for r in ordered.mapInArrow(releasing(write), _SUMMARY).collect())
    bases = np.cumsum([0] + [f[3] for f in files]).tolist()
    manifest = {"dtype": dtype, "end_id": END_ID, "tokenizer": os.path.basename(tokenizer), "tokens": bases[-1],
                "files": [{"name": f[1], "docs": f[2], "tokens": f[3], "base": base} for f, base in zip(files, bases)]}
    disk, folder = _place(root)
    disk.create_dir(folder, recursive=True)
    with disk.open_output_stream(f"{folder}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def _bytes(uri: str, begin: int, length: int) -> memoryview:
    """A range of a file: mapped where the file is local, read where it is not."""
    disk, name = _place(uri)
    if not length:
        return memoryview(b"")
    if isinstance(disk, fs.LocalFileSystem):
        return memoryview(np.memmap(name, np.uint8, "r", begin, (length,)))
    with disk.open_input_file(name) as f:
        return memoryview(f.read_at(length, begin))


def read_tokens(spark: SparkSession, path: str, docs_per_task: int = 20_000, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids of each document, out
    of the files of `write_tokens`. ids_crc32 is that of the ids as little-endian unsigned 32-bit integers."""
    root = path.rstrip("/")
    disk, folder = _place(root)
    with disk.open_input_stream(f"{folder}/manifest.json") as f:
        manifest = json.loads(f.read())
    dtype = np.dtype(manifest["dtype"]).newbyteorder("<")
    slices = [(f["name"], f["base"], at, min(docs_per_task, f["docs"] - at))
              for f in manifest["files"] for at in range(0, f["docs"], docs_per_task)]
    # One row for each `docs_per_task` documents.
    work = spark.createDataFrame(slices, "name string, base bigint, first bigint, docs bigint")
    work = work.repartition(max(1, len(slices)), "name", "first") if slices else work
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.list_(pa.int64()))] if with_ids else []

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file, first, n = f"{root}/{row['name']}", row["first"], row["docs"]
                offsets = np.frombuffer(_bytes(f"{file}.offsets", first * 8, (n + 1) * 8), "<u8").astype(np.int64)
                keys = np.frombuffer(_bytes(f"{file}.docs", first * 8, n * 8), "<i8")
                nulls = np.frombuffer(_bytes(f"{file}.nulls", first, n), "u1").astype(bool)
                ids = np.frombuffer(_bytes(f"{file}.ids", int(offsets[0]) * dtype.itemsize, int(offsets[-1] - offsets[0]) * dtype.itemsize), dtype)
                for at in range(0, n, 2000):
                    bounds = offsets[at : at + 2001] - offsets[0]
                    own = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
                    columns = [pa.array(keys[at : at + 2000], mask=nulls[at : at + 2000]), row["base"] + offsets[0] + bounds[:-1],
                               np.diff(bounds), [zlib.crc32(x.astype("<u4").tobytes()) for x in own]]
                    yield batch_of(fields, columns + ([[x.tolist() for x in own]] if with_ids else []))

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    return work.mapInArrow(releasing(read), T.StructType.fromDDL(schema))


def token_table(docs: DataFrame, tokenizer: str, dtype: str = "uint16", **names: str) -> DataFrame:
    """Write the documents to a new folder under the shared one and read the files back."""
    path = working_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, dtype, **names)
    return read_tokens(docs.sparkSession, path)
