"""SentencePiece ids of whole texts by a table of distinct chunks, and texts of ids."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgate.llm.common import parts
from docgate.session import scratch_path

BLOCK_CHARS = 8_000_000
MIN_BUCKETS = 64
MARK = "\N{LOWER ONE EIGHTH BLOCK}"
# Texts on which normalizers that change more than blanks differ from those that do not.
_PROBES = ("a", " a  b ", "\n\t\r a\x0b\n", "ﬁ①　Ａé​\xa0\x00")


@lru_cache(maxsize=2)
def _processor(model: str):
    """The loaded model, checked: its pieces must not cross a mark or a line end.

    Blanks must become marks with one more in front, and nothing else may be changed.
    """
    import sentencepiece

    made = sentencepiece.SentencePieceProcessor(model_file=model)
    for text in _PROBES:
        if made.normalize(text) != MARK + text.replace(" ", MARK):
            raise ValueError(f"{model}: only blanks may be normalized")
    for k in range(made.get_piece_size()):
        piece = made.id_to_piece(k)
        if re.search(rf"[^{MARK}]{MARK}|\n", piece):
            raise ValueError(f"{model}: piece {k} crosses a mark or a line end")
    return made


# A run of blanks or one line end, and what follows up to the next.
_CHUNK = re.compile(r"(?: +|\n)[^ \n]*")


def chunks(text: str) -> list[str]:
    """``text`` cut where no piece can cross; with the blank put in front of it, nothing is lost."""
    return _CHUNK.findall(" " + text.replace(MARK, " ")) if text else []


def _packed(values: list[bytes], width: int = 1) -> tuple[bytes, bytes]:
    """``values`` as two compressed strings, sizes and contents.

    Numbers of ``width`` bytes are stored as all their first bytes, then all second ones, and so on.
    """
    import numpy as np
    import zstandard

    def squeezed(held: bytes, k: int) -> bytes:
        planes = np.frombuffer(held, dtype=np.uint8).reshape(-1, k).T
        return zstandard.ZstdCompressor(level=9).compress(planes.tobytes())

    sizes = np.array([len(v) for v in values], dtype="<u4")
    return squeezed(sizes.tobytes(), 4), squeezed(b"".join(values), width)


def _unpacked(sizes: bytes, held: bytes, width: int = 1) -> list[bytes]:
    """What :func:`_packed` was given."""
    import numpy as np
    import zstandard

    def whole(held: bytes, k: int) -> bytes:
        planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(held), dtype=np.uint8)
        return planes.reshape(k, -1).T.tobytes()

    made = whole(held, width)
    ends = np.cumsum(np.frombuffer(whole(sizes, 4), dtype="<u4"), dtype=np.int64).tolist()
    return [made[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def cut_blocks(
    docs: DataFrame, keys: list[str], buckets: int, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Blocks of documents, each with a dictionary of its distinct chunks.

    A block is a stretch of one task's rows of about ``block_chars`` characters; a longer text has
    one of its own. One row per block, of null ``bucket``, has the documents (``rows``, structs of
    ``keys``), their texts as numbers of chunks, the most frequent first, and the bucket of each such
    number (``ranks``). The others have the chunks of each bucket, a hash of the chunk, in the same
    order. ``sizes`` and ``held`` are as :func:`_packed` gives them.
    """
    given = docs.select(F.struct(*keys).alias("row"), "text")
    out = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("bucket", T.IntegerType()),
            T.StructField("sizes", T.BinaryType()),
            T.StructField("held", T.BinaryType()),
            T.StructField("ranks", T.BinaryType()),
            T.StructField("rows", T.ArrayType(given.schema["row"].dataType)),
        ]
    )

    def cut(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        codes: dict[str, int] = {}
        kept: list[pa.Array] = []
        texts: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator:
            nonlocal block, codes, kept, texts, size
            if not texts:
                return
            counts = np.zeros(len(codes), dtype=np.int64)
            for text in texts:
                counts += np.bincount(text, minlength=len(codes))
            order = np.argsort(-counts, kind="stable")
            rank = np.zeros(len(codes), dtype="<u4")
            rank[order] = np.arange(len(codes))
            by_bucket: dict[int, list[bytes]] = {}
            ranks, names = [], list(codes)
            for k in order.tolist():
                held = names[k].encode()
                ranks.append(zlib.crc32(held) % buckets)
                by_bucket.setdefault(ranks[-1], []).append(held)
            packed = [_packed([rank[text].tobytes() for text in texts], 4)]
            packed += [_packed(some) for some in by_bucket.values()]
            rows, n = pa.concat_arrays(kept), len(by_bucket)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * (n + 1), pa.int64()),
                    pa.array([None, *by_bucket], pa.int32()),
                    pa.array([p[0] for p in packed], pa.binary()),
                    pa.array([p[1] for p in packed], pa.binary()),
                    pa.array([np.array(ranks, dtype="<u4").tobytes(), *[None] * n], pa.binary()),
                    pa.ListArray.from_arrays(
                        pa.array([0] + [len(rows)] * (n + 1), pa.int32()), rows,
                        mask=pa.array([False] + [True] * n),
                    ),
                ],
                names=out.names,
            )
            block, codes, kept, texts, size = block + 1, {}, [], [], 0

        for batch in batches:
            start = 0
            row, text = batch.column("row"), batch.column("text")
            for at in range(batch.num_rows):
                whole = text[at].as_py() or ""
                found = [codes.setdefault(c, len(codes)) for c in chunks(whole)]
                texts.append(np.array(found, dtype=np.int32))
                size += len(whole) + 64
                if size >= block_chars:
                    kept.append(row.slice(start, at + 1 - start))
                    start = at + 1
                    yield from flush()
            if start < batch.num_rows:
                kept.append(row.slice(start))
        yield from flush()

    return given.mapInArrow(cut, out)


def segment(listed: DataFrame, model: str, buckets: int) -> DataFrame:
    """``listed`` dictionary rows with the ids of their chunks instead of these.

    All chunks of a bucket come together: they meet one table, in which each distinct chunk is
    segmented once. A chunk is segmented behind a full stop, whose ids are cut off: alone, it would
    be given one more blank, and only blanks would give nothing.
    """

    def encode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        made = _processor(model)
        skip = len(made.encode("."))
        table: dict[bytes, bytes] = {}
        for batch in batches:
            packed = []
            for sizes, held in zip(batch.column("sizes"), batch.column("held"), strict=True):
                wanted = _unpacked(sizes.as_py(), held.as_py())
                new = [c for c in wanted if c not in table]
                for at in range(0, len(new), 1_000):
                    some = new[at : at + 1_000]
                    found = made.encode(["." + c.decode() for c in some], num_threads=1)
                    for chunk, ids in zip(some, found, strict=True):
                        table[chunk] = np.array(ids[skip:], dtype="<u4").tobytes()
                packed.append(_packed([table[c] for c in wanted], 4))
            columns = {c: batch.column(c) for c in batch.schema.names}
            columns["sizes"] = pa.array([p[0] for p in packed], pa.binary())
            columns["held"] = pa.array([p[1] for p in packed], pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return listed.repartitionById(buckets, F.col("bucket")).mapInArrow(encode, listed.schema)


def encode_texts(
    docs: DataFrame,
    model: str,
    keys: tuple[str, ...] = ("doc_id",),
    begin: bool = True,
    end: bool = True,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``keys`` of every document and ``ids``: its whole text as the library encodes it.

    ``ids`` holds little-endian unsigned 32-bit integers. ``model`` is the path of a model file that
    every executor can open; a model whose pieces cross white space marks or line ends, or that
    normalizes more than blanks, is refused. Documents are gathered into blocks, whose texts become
    numbers of their distinct chunks. These chunks alone meet, by hash, the table in which each
    distinct chunk is segmented once; the ids return to the block and are put in place. So a word
    that every text has costs one entry per block, and texts, stored as compressed numbers, do not move.

    A null or empty text gives the begin and end ids alone; a very long one is a block of its own.
    Rows that repeat a key are encoded one by one; other columns are left out, and ``keys`` may have
    any names but ``ids``. An empty table gives no rows.
    """
    spark = docs.sparkSession
    buckets = max(MIN_BUCKETS, parts(docs))
    # Written by block, so that the texts stay where they are when their ids arrive. The name is
    # needed for writing only: it goes at once, the files stay in the shared folder.
    table = f"llm_blocks_{uuid.uuid4().hex}"
    writer = cut_blocks(docs, list(keys), buckets, block_chars).write.bucketBy(parts(docs), "block")
    writer.option("path", scratch_path(spark, "llm-blocks")).saveAsTable(table)
    blocks = spark.table(table)
    spark.sql(f"drop table {table}")
    listed = segment(blocks.where("bucket is not null").drop("ranks", "rows"), model, buckets)
    texts = blocks.where("bucket is null").drop("bucket")
    kind = blocks.schema["rows"].dataType.elementType
    out = T.StructType([T.StructField("row", kind), T.StructField("ids", T.BinaryType())])

    def put(text, found):
        import numpy as np
        import pyarrow as pa

        made = _processor(model)
        mark = [np.array([k], dtype="<u4").tobytes() for k in (made.bos_id(), made.eos_id())]
        front, back = mark[0] if begin else b"", mark[1] if end else b""
        by_bucket = {
            bucket: iter(_unpacked(sizes, held, 4))
            for bucket, sizes, held in zip(*(found.column(c).to_pylist() for c in ("bucket", "sizes", "held")), strict=True)
        }
        ranks = np.frombuffer(text.column("ranks")[0].as_py(), dtype="<u4").tolist()
        known = [next(by_bucket[k]) for k in ranks]
        ids = []
        for held in _unpacked(text.column("sizes")[0].as_py(), text.column("held")[0].as_py(), 4):
            codes = np.frombuffer(held, dtype="<u4").tolist()
            ids.append(b"".join([front, *map(known.__getitem__, codes), back]))
        rows = text.column("rows").combine_chunks().flatten()
        return pa.table([rows, pa.array(ids, pa.binary())], names=["row", "ids"])

    placed = texts.groupBy("block").cogroup(listed.groupBy("block")).applyInArrow(put, out)
    return placed.select(*[F.col("row")[k].alias(k) for k in keys], "ids")


def decode_ids(rows: DataFrame, model: str, name: str = "decoded") -> DataFrame:
    """``rows`` with the text that the library decodes from ``ids``, as column ``name``.

    ``ids`` are as :func:`encode_texts` gives them. Null or no ids give an empty text. No shuffle.
    """
    out = T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())])

    def decode(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        made = _processor(model)
        for batch in batches:
            texts = [
                made.decode(np.frombuffer(held or b"", dtype="<u4").tolist()) or ""
                for held in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, name]
            )

    return rows.mapInArrow(decode, out)
