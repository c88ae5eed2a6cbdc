"""Token ids as Arrow files of equal-length sequences.

Documents are ordered by id, encoded, and laid end to end; the ids of a shard are cut into sequences of one length. A shard is
an Arrow file whose record batches hold two fixed-size lists, ids and mask, so a reader maps it and takes any sequence without copying. The last
sequence of a shard is padded, mask 0. A second Arrow file lists where each document starts. Executors write both under a name of their
own attempt into the shared folder and report it; only names that a finished task reported are read, so a lost or repeated task leaves no trace in the result.
"""

from __future__ import annotations

import os
import re
import sys
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import stage, staging_path
from .common import kept, lean, ranges, slices

LENGTH = 2048
END_ID = 0
#: Sequences in a record batch, and ids after which a task begins another shard.
BATCH_ROWS = 256
SHARD_IDS = 1 << 26
#: Bytes of encoded pieces a worker remembers, and those of one beside its text and ids (number, place in the dictionary, end, uses); beyond, the half
#: used least goes.
CACHE, ENTRY = 80 << 20, 112
#: New pieces given to the tokenizer at once; its objects are dropped before the next.
TOGETHER = 32
# Unicode white space, as the tokenizer's own pattern splits it.
_SPACE = "\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
_PIECE = re.compile(f" ?[{_LETTERS}]++(?=[.,;:!?|%&*#$/()'\"-])| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


class _Codes(dict):
    """Numbers pieces as they are first asked for, and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        self[piece] = code = len(self)
        self.fresh.append(piece)
        return code


class Encoder:
    """Ids of whole texts by a tokenizer file.

    The file's pattern never joins what stands on both sides of a cut made here (before a space and a run of other characters, around other white
    space, after the first letters of a run if punctuation follows), so each distinct piece is encoded once. Special strings are cut out first, as the tokenizer does.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.forget()

    def forget(self):
        self.known, self.ids, self.ends = _Codes(), np.empty(0, dtype=self.width), np.zeros(1, dtype=np.int64)
        self.uses, self.held = np.zeros(0, dtype=np.int64), 0

    def _size(self, pieces: list[str], ids: int) -> int:
        return sum(map(sys.getsizeof, pieces)) + ENTRY * len(pieces) + ids * self.ids.itemsize

    def _drop_rare(self):
        """The half of the pieces used most stays; former uses count half from now on."""
        often = np.sort(np.argsort(-self.uses, kind="stable")[: len(self.uses) // 2])
        pieces = list(self.known)
        pieces = [pieces[i] for i in often.tolist()]
        counts = np.diff(self.ends)[often]
        ids, uses = self.ids[ranges(self.ends[often], counts)], self.uses[often] // 2
        held = self._size(pieces, len(ids))
        self.forget()
        if held <= CACHE // 4 * 3:  # else a few long pieces hold most
            self.known.update(zip(pieces, range(len(pieces))))
            self.ids, self.ends, self.uses, self.held = ids, np.concatenate([[0], np.cumsum(counts)]), uses, held

    def _pieces(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return _PIECE.findall(text)
        found = []
        for k, part in enumerate(self.special.split(text)):
            found += [part] if k % 2 else _PIECE.findall(part)
        return found

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many each text has."""
        # a batch that failed half way may have left pieces without ids
        if len(self.known) != len(self.ends) - 1:
            self.forget()
        elif self.held > CACHE:
            self._drop_rare()
        split = [self._pieces(t) for t in texts]
        which = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), dtype=np.int64)
        fresh, self.known.fresh = self.known.fresh, []
        if fresh:
            coded = [c.ids for at in range(0, len(fresh), TOGETHER)
                     for c in self.tokenizer.encode_batch_fast(fresh[at:at + TOGETHER], add_special_tokens=False)]
            sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(coded), dtype=self.width, count=int(sizes.sum()))])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
            self.held += self._size(fresh, int(sizes.sum()))
        uses = np.bincount(which, minlength=len(self.known))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        ids, ends = self.ids, self.ends
        counts = ends[which + 1] - ends[which]
        sums = np.concatenate([[0], np.cumsum(counts)])
        bounds = np.concatenate([[0], np.cumsum([len(pieces) for pieces in split])])
        return ids[ranges(ends[which], counts)], np.diff(sums[bounds])


def encoder(path: str) -> Encoder:
    """One encoder for each file and worker process."""
    known = kept("encoders")
    return known[path] if path in known else known.setdefault(path, Encoder(path))


class _Shard:
    """Writes one shard: ids by sequences, documents by rows."""

    def __init__(self, folder: str, name: str, length: int, width):
        self.files, self.base = pa.fs.FileSystem.from_uri(folder)
        self.names = [f"{name}.arrow", f"{name}-docs.arrow"]
        self.length, self.width = length, width
        kind = pa.from_numpy_dtype(width)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.rows = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.sinks = [self.files.open_output_stream(f"{self.base}/{n}") for n in self.names]
        self.writers = [pa.ipc.new_file(s, x) for s, x in zip(self.sinks, (self.schema, self.rows))]
        self.rest, self.written = np.empty(0, dtype=width), 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray):
        starts = self.written + np.cumsum(counts) - counts
        self.writers[1].write(pa.record_batch([doc_ids, pa.array(starts), pa.array(counts)], schema=self.rows))
        self.written += len(ids)
        self.rest = np.concatenate([self.rest, ids])
        step = self.length * BATCH_ROWS
        while len(self.rest) >= step:
            self._put(self.rest[:step], step)
            self.rest = self.rest[step:]

    def _put(self, ids: np.ndarray, real: int):
        mask = pa.array(np.arange(len(ids)) < real)
        self.writers[0].write(pa.record_batch([pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
                                               pa.FixedSizeListArray.from_arrays(mask, self.length)], schema=self.schema))

    def close(self) -> int:
        if len(self.rest):
            padded = -(-len(self.rest) // self.length) * self.length
            self._put(np.pad(self.rest, (0, padded - len(self.rest))), len(self.rest))
        for writer, sink in zip(self.writers, self.sinks):
            writer.close()
            sink.close()
        return self.written


MANIFEST = "part int, shard int, ids_file string, docs_file string, n_ids long, n_docs long"


def write_sequences(docs: DataFrame, tokenizer_path: str, folder: str | None = None, id_col: str = "doc_id",
                    text_col: str = "text", length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Write the files and return their manifest, in order: ``part, shard, ids_file, docs_file, n_ids, n_docs, first_id``.

    Null and empty texts consist of the end id alone. Rows with a null id come first; rows with one id are ordered by their text. An
    empty table writes nothing.
    """
    spark = docs.sparkSession
    folder = folder or staging_path(spark, "sequences")
    folder = folder if "://" in folder or folder.startswith("/") else folder.replace("file:", "file://", 1)
    run_id = uuid.uuid4().hex[:8]

    def run(batches):
        coder, shard, rows, count, number = encoder(tokenizer_path), None, [], 0, 0
        context = TaskContext.get()
        part = context.partitionId()

        def done():
            return (part, number, f"{folder}/{shard.names[0]}", f"{folder}/{shard.names[1]}", shard.close(), count)

        for batch in batches:
            for piece in slices(batch, 1, 1 << 20):
                if shard is None:
                    files, base = pa.fs.FileSystem.from_uri(folder)
                    files.create_dir(base, recursive=True)
                    shard = _Shard(folder, f"{run_id}-{part:06d}-{number:04d}-{context.taskAttemptId()}", length, coder.width)
                ids, counts = coder.encode([t or "" for t in piece.column(1).to_pylist()])
                ends = np.cumsum(counts)
                shard.add(piece.column(0), np.insert(ids, ends, end_id), counts + 1)
                count += piece.num_rows
                if shard.written >= SHARD_IDS:
                    rows.append(done())
                    shard, count, number = None, 0, number + 1
        if shard is not None:
            rows.append(done())
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip([f.split()[0] for f in MANIFEST.split(", ")], map(list, zip(*rows)))), schema=pa.schema([
                ("part", pa.int32()), ("shard", pa.int32()), ("ids_file", pa.string()), ("docs_file", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64())]))

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = plain.repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text"))
    manifest = stage(ordered.mapInArrow(lean(run, "encoders"), MANIFEST), "manifest")
    before = F.sum("n_ids").over(W.partitionBy(F.lit(0)).orderBy("part", "shard").rowsBetween(W.unboundedPreceding, -1))
    return manifest.withColumn("first_id", F.coalesce(before, F.lit(0)))


def read_sequences(ids_file: str) -> tuple[pa.Table, np.ndarray]:
    """A shard's table (random access by row) and its ids as one array; mapped, not read, where the file is local."""
    files, path = pa.fs.FileSystem.from_uri(ids_file)
    source = pa.memory_map(path) if isinstance(files, pa.fs.LocalFileSystem) else files.open_input_file(path)
    table = pa.ipc.open_file(source).read_all()
    parts = [c.flatten().to_numpy(zero_copy_only=True) for c in table.column("ids").chunks]
    return table, parts[0] if len(parts) == 1 else np.concatenate(parts)


def read_documents(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                files, path = pa.fs.FileSystem.from_uri(row["docs_file"])
                with files.open_input_file(path) as source:
                    docs = pa.ipc.open_file(source).read_all()
                ids = read_sequences(row["ids_file"])[1]
                starts, counts = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
                crc = [zlib.crc32(ids[a:a + n].astype("<u4")) for a, n in zip(starts.tolist(), counts.tolist())]
                out = pa.table([docs.column("doc_id"), pa.array(starts + row["first_id"]), pa.array(counts), pa.array(crc, pa.int64())],
                               names=["doc_id", "start", "n_tokens", "ids_crc32"])
                yield from out.to_batches(max_chunksize=1 << 16)

    shards = manifest.select("ids_file", "docs_file", "first_id")
    spread = max(1, min(manifest.sparkSession.sparkContext.defaultParallelism * 4, manifest.count()))
    return shards.repartition(spread).mapInArrow(lean(run), "doc_id long, start long, n_tokens long, ids_crc32 long")
