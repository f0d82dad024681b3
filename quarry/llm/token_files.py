"""Token ids as Arrow files: equal-length sequences and masks in fixed-size-list batches.

Texts are brought into ascending id order by ranges, encoded, and each followed by an end id; each range is
one stream of ids, cut into sequences of equal length. A range is written as two Arrow IPC files: sequences
(`ids` and `mask`, fixed-size lists without compression, so that any sequence is a view into the mapped
file) and documents (id, start and length in the range's stream). The last sequence of a range is filled up
with zeros, and its mask says so. Files get names of their own attempt, and only files that the manifest
lists count, so that a lost executor or a repeated task leaves no half-written file behind.

Ids take 2 bytes if the vocabulary allows, else 4. Encoding is the tokenizers library's; what stands between
two cuts that no pre-token crosses is encoded once and then kept in a bounded table; what a block of text needs
besides the table is encoded by one call.

Defined cases. Null text counts as empty: one id, the end. Null document ids come first. Rows that share an
id stand in the order of their texts. Empty input: no files. Other columns are dropped.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import Bounded, read_spec
from .shared import documents, map_arrow, scratch, stored, worker_keeps

LENGTH = 2048
#: Sequences in a batch.
BATCH = 64
END = 2
#: Characters of a text that are cut into pieces at once.
BLOCK = 1 << 20
_W = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Where the byte-level pattern always begins a new pre-token: before a blank that leads a word, and around other white space.
PIECE = re.compile(f" ?[^{_W}]+|[{_W}]+(?![^{_W}])|[{_W}]+")
CUT = re.compile(f"(?<=[^{_W}]) (?=[^{_W}])")

#: How the byte-level alphabet writes a blank.
BLANK = "\u0120"


def marked(piece: str) -> bool:
    """A word with a comma or a full stop behind it."""
    return len(piece) > 2 and piece[-1] in ".," and piece[1:-1].isalpha() and (piece[0] == " " or piece[0].isalpha())


class Encoder:
    """Texts to bytes of little-endian ids, by the tokenizers library."""

    def __init__(self, spec: str, table: int = 400_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [x["content"] for x in json.loads(spec)["added_tokens"]]
        self.kind = np.dtype("<u2") if self.tokenizer.get_vocab_size(True) <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        vocab = self.tokenizer.get_vocab(True)
        self.leads = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.leads[[k for t, k in vocab.items() if t.startswith(BLANK)]] = True
        self.joins = not any(" " in s for s in self.special)
        self.table, self.ahead = Bounded(self._piece, table), {}

    def _piece(self, piece: str) -> bytes:
        if marked(piece):
            return self.table[piece[:-1]] + self.table[piece[-1]]  # a mark behind a word is a pre-token of its own
        return self.ahead.get(piece) or self._one(piece)

    def _ids(self, text: str) -> array:
        return array(self.code, self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _one(self, piece: str) -> bytes:
        return self._ids(piece).tobytes()

    def _together(self, missing: list[str]) -> dict[str, bytes]:
        """Words behind a blank that the table lacks, encoded by one call: each begins a pre-token, and only its first token begins with a blank."""
        known, aside = self.table, self.table.aside
        words = dict.fromkeys(p[:-1] if marked(p) else p for p in missing)
        words = [w for w in words if len(w) > 1 and w[0] == " " and not w.isspace() and w not in known and w not in aside]
        if len(words) < 2 or not self.joins:
            return {}
        ids = self._ids("".join(words))
        starts = np.flatnonzero(self.leads[np.frombuffer(ids, self.kind)])
        if len(starts) != len(words):
            return {}
        data, at = ids.tobytes(), [*(starts * self.kind.itemsize).tolist(), len(ids) * self.kind.itemsize]
        return {w: data[i:j] for w, i, j in zip(words, at, at[1:])}

    def _pieces(self, text: str) -> bytes:
        pieces = PIECE.findall(text)
        found = list(map(self.table.get, pieces))
        if None in found:
            self.ahead = self._together([p for p, ids in zip(pieces, found) if ids is None])
            found = [self.table[p] if ids is None else ids for p, ids in zip(pieces, found)]
            self.ahead = {}
        return b"".join(found)

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if any(s in text for s in self.special):
            return self._one(text)
        if len(text) <= BLOCK:
            return self._pieces(text)
        out, at = [], 0
        while at < len(text):
            cut = CUT.search(text, at + BLOCK)
            end = cut.start() if cut else len(text)
            out.append(self._pieces(text[at:end]))
            at = end
        return b"".join(out)


def encoder_of(spec: str) -> Encoder:
    """A worker's encoder, kept with its table from task to task."""
    return worker_keeps(("encoder", spec), lambda: Encoder(spec))


def _schema(kind: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))])


def open_folder(uri: str):
    """The file system of a URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + os.path.abspath(uri))


class Writer:
    """Puts documents' ids, one after the other, into a range's two files."""

    def __init__(self, uri: str, name: str, kind: np.dtype, length: int, id_type: pa.DataType):
        self.fs, folder = open_folder(uri)
        self.fs.create_dir(folder, recursive=True)
        self.files = [f"{name}.sequences.arrow", f"{name}.documents.arrow"]
        self.schemas = [_schema(kind, length), pa.schema([("id", id_type), ("start", pa.int64()), ("n_tokens", pa.int64())])]
        self.streams = [self.fs.open_output_stream(f"{folder}/{f}") for f in self.files]
        self.out = [pa.ipc.new_file(s, x) for s, x in zip(self.streams, self.schemas)]
        self.kind, self.length, self.rest, self.n, self.rows = kind, length, [], 0, []
        self.waiting = 0

    def add(self, doc_id, ids: bytes) -> None:
        size = len(ids) // self.kind.itemsize
        self.rows.append((doc_id, self.n, size))
        self.rest.append(ids)
        self.n += size
        self.waiting += size
        if self.waiting >= self.length * BATCH:
            self._sequences(False)
        if len(self.rows) >= 10_000:
            self._documents()

    def _sequences(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.rest), self.kind)
        full = len(ids) // self.length
        for at in range(0, full, BATCH):
            n = min(BATCH, full - at)
            self._put(ids[at * self.length : (at + n) * self.length], n, n * self.length)
        ids = ids[full * self.length :]
        if last and len(ids):
            self._put(np.concatenate([ids, np.zeros(self.length - len(ids), self.kind)]), 1, len(ids))
            ids = ids[:0]
        self.rest, self.waiting = [ids.tobytes()], len(ids)

    def _put(self, ids: np.ndarray, n: int, real: int) -> None:
        mask = pa.array(np.arange(n * self.length) < real)
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length), pa.FixedSizeListArray.from_arrays(mask, self.length)]
        self.out[0].write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schemas[0]))

    def _documents(self) -> None:
        columns = [pa.array([r[k] for r in self.rows], f.type) for k, f in enumerate(self.schemas[1])]
        self.out[1].write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schemas[1]))
        self.rows = []

    def close(self) -> None:
        self._sequences(True)
        self._documents()
        for x in [*self.out, *self.streams]:
            x.close()


class TokenFile:
    """A range's files, opened for random access. Local files are mapped: a sequence is a view, not a copy."""

    def __init__(self, uri: str, sequences: str, docs: str):
        self.fs, folder = open_folder(uri)
        local = self.fs.type_name == "local"
        opened = [pa.memory_map(f"{folder}/{f}") if local else self.fs.open_input_file(f"{folder}/{f}") for f in (sequences, docs)]
        self.reader, self.docs = map(pa.ipc.open_file, opened)
        self.length = self.reader.schema.field("ids").type.list_size
        self._at: dict[int, tuple[np.ndarray, pa.Array]] = {}

    def _batch(self, k: int) -> tuple[np.ndarray, pa.Array]:
        if k not in self._at:
            batch = self.reader.get_batch(k)
            self._at = {k: (batch.column("ids").flatten().to_numpy(zero_copy_only=True), batch.column("mask").flatten())}
        return self._at[k]

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids and the mask of sequence k."""
        ids, mask = self._batch(k // BATCH) if k // BATCH < self.reader.num_record_batches else self._batch(self.reader.num_record_batches - 1)
        at = k % BATCH * self.length
        return ids[at : at + self.length], mask.slice(at, self.length).to_numpy(zero_copy_only=False)

    def documents(self) -> Iterator[tuple]:
        """(id, start, n_tokens, blocks of ids) of each document in order; masked ids are left out."""
        k, base, left = -1, 0, np.zeros(0)
        for b in range(self.docs.num_record_batches):
            for row in self.docs.get_batch(b).to_pylist():
                blocks, start, n = [], row["start"], row["n_tokens"]
                while n > 0:
                    if start >= base + len(left):
                        base += len(left)
                        k += 1
                        ids, mask = self._batch(k)
                        left = ids[: mask.true_count] if mask.true_count < len(ids) else ids
                    part = left[start - base : start - base + n]
                    blocks.append(part)
                    start, n = start + len(part), n - len(part)
                yield row["id"], row["start"], row["n_tokens"], blocks


def write_tokens(df: DataFrame, uri: str, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end: int = END) -> DataFrame:
    """Writes `df`'s texts as files under `uri`. Gives the manifest: part, sequences, docs, n_docs, n_tokens, id_type, in id order by part."""
    from pyspark.sql.pandas.types import to_arrow_type

    name, kind = df.schema[id_col].dataType.simpleString(), to_arrow_type(df.schema[id_col].dataType)
    shared = df.sparkSession.sparkContext.broadcast(read_spec(path))
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    start = F.substring("text", 1, 64)  # rows of one id may go to several ranges, in the order of their texts
    ordered = rows.withColumn("start", start).repartitionByRange("id", "start").sortWithinPartitions("id", "text").select("id", "text")

    def run(batches):
        from pyspark import TaskContext

        encoder = encoder_of(shared.value)
        last, task, out, n = np.array([end], encoder.kind).tobytes(), TaskContext.get(), None, 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                out = out or Writer(uri, f"{task.partitionId():06d}-{uuid.uuid4().hex}", encoder.kind, length, kind)
                out.add(doc_id.as_py(), encoder.encode(text.as_py()) + last)
                n += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([task.partitionId()], pa.int32()), "sequences": [out.files[0]], "docs": [out.files[1]], "n_docs": [n], "n_tokens": [out.n], "id_type": [name]})

    return stored(map_arrow(ordered, run, "part int, sequences string, docs string, n_docs long, n_tokens long, id_type string"), "token-manifest")


def read_tokens(manifest: DataFrame, uri: str) -> DataFrame:
    """id, start, n_tokens and ids_crc32 of each document, all from the files. The manifest has a row for each file; the driver adds up their lengths."""
    spark = manifest.sparkSession
    rows, base, id_type = [], 0, "bigint"
    for r in manifest.orderBy("part").collect():
        rows.append((r.part, r.sequences, r.docs, base))
        base, id_type = base + r.n_tokens, r.id_type
    if not rows:
        return spark.createDataFrame([], f"id {id_type}, start long, n_tokens long, ids_crc32 long")
    files = spark.createDataFrame(rows, "part int, sequences string, docs string, base long").repartitionByRange(len(rows), "part")

    def run(batches):
        for batch in batches:
            for f in batch.to_pylist():
                found, file = [], TokenFile(uri, f["sequences"], f["docs"])
                kind = file.docs.schema.field("id").type
                for doc_id, start, n, blocks in file.documents():
                    crc = 0
                    for ids in blocks:
                        crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                    found.append((doc_id, f["base"] + start, n, crc))
                    if len(found) == 10_000:
                        yield _rows(found, kind)
                        found = []
                yield _rows(found, kind)

    return map_arrow(files, run, f"id {id_type}, start long, n_tokens long, ids_crc32 long")


def _rows(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], pa.int64() if k else kind) for k in range(4)], names=["id", "start", "n_tokens", "ids_crc32"])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = scratch(spark, "tokens")
    manifest = write_tokens(documents(spark, sf_dir), uri, default_path())
    return read_tokens(manifest, uri).withColumnRenamed("id", "doc_id")


QUERIES = {"op3_token_files": op3_token_files}
SQL: dict[str, str] = {}
