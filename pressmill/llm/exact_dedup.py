"""Grace hash deduplication.

Two rounds of the same hash table. The first runs where the rows are read and folds the copies that one input
partition holds, so that of a hot text at most one row a partition is shuffled. The second runs on what was shuffled
by digest. A table holds each different content once, in an open-addressing index, and compares complete contents.
When the contents pass its budget, rows that match nothing in it are dealt over spill files by further bits of their
digest, and each file is taken in turn, dealt again where it is still too large. A spill file belongs to one task
attempt, which alone writes, reads and deletes it.

Defined results: null text counts as empty; equal means equal after each run of ASCII white space becomes one space;
of equal texts the smallest doc_id stays (null ids last); of rows repeated with the same id one is kept; an empty table
gives an empty table.
"""

from __future__ import annotations

import hashlib
import pickle
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, StructField, StructType

from pressmill.llm.common import small_batches, staged, table, texts

WHITE = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
#: Bytes of different contents that a table holds before it spills.
TABLE_BYTES = 48 << 20
FANOUT_BITS = 4
NO_ID = (1 << 63) - 1


def normalised(data: bytes) -> bytes:
    """Each run of space and \\x09-\\x0D becomes one space."""
    data = data.translate(WHITE)
    while b"  " in data:
        data = data.replace(b"  ", b" ")
    return data


class ContentTable:
    """Open addressing over complete contents; the digest only chooses the slot and the order of comparison."""

    def __init__(self, slots: int = 1 << 10):
        self.index = np.full(slots, -1, np.int64)
        self.digests: list[bytes] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, digest: bytes, content: bytes) -> tuple[int, int]:
        """The class of a content or -1, and the slot where the search ended."""
        mask = len(self.index) - 1
        slot = int.from_bytes(digest[8:16], "little") & mask
        while (at := int(self.index[slot])) >= 0:
            if self.digests[at] == digest and self.contents[at] == content:
                return at, slot
            slot = (slot + 1) & mask
        return -1, slot

    def add(self, digest: bytes, content: bytes, slot: int) -> int:
        at = len(self.contents)
        self.index[slot] = at
        self.digests.append(digest)
        self.contents.append(content)
        self.bytes += len(content)
        if 2 * (at + 1) > len(self.index):
            self._grow()
        return at

    def _grow(self) -> None:
        self.index = np.full(2 * len(self.index), -1, np.int64)
        mask = len(self.index) - 1
        for at, digest in enumerate(self.digests):
            slot = int.from_bytes(digest[8:16], "little") & mask
            while self.index[slot] >= 0:
                slot = (slot + 1) & mask
            self.index[slot] = at


LOCAL = pa.schema([("token", pa.int64()), ("rep", pa.int64()), ("doc_id", pa.int64()), ("sha", pa.binary()), ("keep", pa.int64()), ("keep_token", pa.int64()), ("n", pa.int64()), ("content", pa.binary())])


def fold_locally(budget: int):
    """Rows of one partition to member rows (token, rep, doc_id, sha) and one class row (rep, keep, n, content) for each
    content. Past the budget the table is emptied and started anew: folding early only saves traffic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = (TaskContext.get().partitionId() << 36) if TaskContext.get() else 0
        seen, reps = ContentTable(), []

        def flush() -> Iterator[pa.RecordBatch]:
            step = 64
            for i in range(0, len(reps), step):
                part = reps[i : i + step]
                size = len(part)
                none = pa.nulls(size, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [none, pa.array([r[0] for r in part], pa.int64()), none, pa.array(seen.digests[i : i + size], pa.binary()), pa.array([r[1] for r in part], pa.int64()), pa.array([r[2] for r in part], pa.int64()), pa.array([r[3] for r in part], pa.int64()), pa.array(seen.contents[i : i + size], pa.binary())],
                    schema=LOCAL,
                )

        for batch in batches:
            ids = batch.column(0).to_pylist()
            tokens, owners, shas = [], [], []
            for doc_id, value in zip(ids, batch.column(1)):
                content = normalised(value.as_buffer().to_pybytes())
                digest = hashlib.sha256(content).digest()
                at, slot = seen.find(digest, content)
                order = NO_ID if doc_id is None else doc_id
                if at < 0:
                    at = seen.add(digest, content, slot)
                    reps.append([token, order, token, 0])
                rep = reps[at]
                rep[1], rep[2] = min((rep[1], rep[2]), (order, token))
                rep[3] += 1
                tokens.append(token)
                owners.append(rep[0])
                shas.append(digest)
                token += 1
            size = len(ids)
            none = pa.nulls(size, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(owners, pa.int64()), pa.array(ids, pa.int64()), pa.array(shas, pa.binary()), none, none, none, pa.nulls(size, pa.binary())], schema=LOCAL)
            if seen.bytes > budget:
                yield from flush()
                seen, reps = ContentTable(), []
        yield from flush()

    return run


#: rep, keep, keep_token, n, digest, length of the content that follows
RECORD = "<qqqq32sI"
GLOBAL = pa.schema([("rep", pa.int64()), ("keep", pa.int64()), ("keep_token", pa.int64()), ("group_size", pa.int64())])


def grace(budget: int):
    """Class rows of one shuffle partition, in any order, to (rep, keep, keep_token, group_size)."""

    def one_table(records: Iterator[tuple], level: int) -> Iterator[pa.RecordBatch]:
        seen, stats, members, spills, full = ContentTable(), [], [], {}, False
        for rep, keep, keep_token, n, digest, content in records:
            at, slot = seen.find(digest, content)
            if at < 0 and full:
                bits = int.from_bytes(digest[16:24], "little") >> (FANOUT_BITS * (level % 16)) & ((1 << FANOUT_BITS) - 1)
                if bits not in spills:
                    spills[bits] = tempfile.TemporaryFile()
                spills[bits].write(struct.pack(RECORD, rep, keep, keep_token, n, digest, len(content)) + content)
                continue
            if at < 0:
                at = seen.add(digest, content, slot)
                stats.append([keep, keep_token, 0])
                full = seen.bytes > budget
            stat = stats[at]
            stat[0], stat[1] = min((stat[0], stat[1]), (keep, keep_token))
            stat[2] += n
            members.append((rep, at))
        for i in range(0, len(members), 10_000):
            part = members[i : i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in part], pa.int64()), *(pa.array([stats[at][k] for _, at in part], pa.int64()) for k in range(3))], schema=GLOBAL)
        del seen, stats, members
        for spill in spills.values():
            yield from one_table(reread(spill), level + 1)
            spill.close()

    def reread(spill) -> Iterator[tuple]:
        spill.seek(0)
        while head := spill.read(struct.calcsize(RECORD)):
            *numbers, digest, size = struct.unpack(RECORD, head)
            yield (*numbers, digest, spill.read(size))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(6)))

    return lambda batches: one_table(records(batches), 0)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    small_batches(docs.sparkSession)
    local = staged(
        texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(fold_locally(table_bytes), "token long, rep long, doc_id long, sha binary, keep long, keep_token long, n long, content binary"),
        "exact-local",
    )
    classes = local.where("content is not null").select("rep", "keep", "keep_token", "n", "sha", "content")
    classes = classes.repartition("sha").mapInArrow(grace(table_bytes), "rep long, keep long, keep_token long, group_size long")
    members = local.where("token is not null").select("token", "rep", "doc_id", "sha")
    return members.join(classes, "rep").select(
        "doc_id",
        F.when(F.col("keep") != NO_ID, F.col("keep")).alias("keep_id"),
        "group_size",
        (F.col("token") == F.col("keep_token")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def best_rows(budget: int, row_type: pa.DataType, last: bool):
    """(doc_id, text, row) to (sha, doc_id, text, row) of the row that stays of each content. The first round empties a full
    table and goes on; the last one, which has all copies of a content in its partition, spills what a full table lacks."""
    schema = pa.schema([("sha", pa.binary()), ("doc_id", pa.int64()), ("text", pa.string()), ("row", row_type)])

    def order(record: tuple) -> tuple:
        doc_id, text, row = record
        return NO_ID if doc_id is None else doc_id, text is not None, text or "", repr(row)

    def given_out(seen: ContentTable, best: list[tuple]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(best), 64):
            part = best[i : i + 64]
            yield pa.RecordBatch.from_arrays([pa.array(seen.digests[i : i + 64], pa.binary()), *(pa.array([r[c] for r in part], schema.field(c + 1).type) for c in range(3))], schema=schema)

    def one_table(records: Iterator[tuple], level: int) -> Iterator[pa.RecordBatch]:
        seen, best, spills = ContentTable(), [], {}
        for record in records:
            content = normalised((record[1] or "").encode())
            digest = hashlib.sha256(content).digest()
            at, slot = seen.find(digest, content)
            if at < 0 and seen.bytes > budget:
                if last:
                    bits = int.from_bytes(digest[16:24], "little") >> (FANOUT_BITS * (level % 16)) & ((1 << FANOUT_BITS) - 1)
                    if bits not in spills:
                        spills[bits] = tempfile.TemporaryFile()
                    pickle.dump(record, spills[bits])
                    continue
                yield from given_out(seen, best)
                seen, best = ContentTable(), []
                at, slot = seen.find(digest, content)
            if at < 0:
                seen.add(digest, content, slot)
                best.append(record)
            elif order(record) < order(best[at]):
                best[at] = record
        yield from given_out(seen, best)
        del seen, best
        for spill in spills.values():
            yield from one_table(reread(spill), level + 1)
            spill.close()

    def reread(spill) -> Iterator[tuple]:
        spill.seek(0)
        while True:
            try:
                yield pickle.load(spill)
            except EOFError:
                return

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(3)))

    return lambda batches: one_table(records(batches), 0)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows and columns of the documents that stay. Whole rows pass through the tables, so one shuffle by digest is
    all; of rows of the same id the least text, then the least other columns, stays."""
    small_batches(docs.sparkSession)
    others = [c for c in docs.columns if c != text_col]
    plain = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), F.struct(*(docs[c].alias(f"c{k}") for k, c in enumerate(others))).alias("row"))
    row_type, schema = to_arrow_type(plain.schema["row"].dataType), StructType([StructField("sha", BinaryType()), *plain.schema.fields])
    folded = plain.mapInArrow(best_rows(table_bytes, row_type, False), schema)
    kept = folded.repartition("sha").select("doc_id", "text", "row").mapInArrow(best_rows(table_bytes, row_type, True), schema)
    columns = {c: F.col(f"row.c{k}") for k, c in enumerate(others)} | {text_col: F.col("text").cast(docs.schema[text_col].dataType)}
    return kept.select(*(columns[c].alias(c) for c in docs.columns))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
with n as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents
), g as (
  select *, min(doc_id) over (partition by text_sha256) as keep_id, count(*) over (partition by text_sha256) as group_size from n
)
select doc_id, keep_id, cast(group_size as bigint) as group_size, doc_id = keep_id as kept, text_sha256 from g
"""
