"""Byte-pair encoding and decoding of whole texts through a table of the distinct words.

Texts are cut into words in blocks. A block keeps its distinct words and, for each text, the numbers of its words in
order; the distinct words of all blocks are encoded once, and their ids go back to the blocks.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewarden.llm.blocks import bucket_of
from tablewarden.llm.common import char_class, flat, query, read, settled, slices, word_hashes
from tablewarden.llm.packing import cuts_apart, vocabulary
from tablewarden.session import new_path

BLOCK_BYTES = 8 << 20  # text of a block; a longer text is a block of its own
LONG_WORD = 512  # bytes from which a word is cut again by the vocabulary's own rule
SHARE_BYTES = 8 << 20  # words of a share of the table of words
BATCH = 4096  # distinct words encoded by one call

BLANK = 0x20
# No white space begins with these bytes, so a blank before them belongs to the word that follows.
BODY = char_class([*range(0x21, 0x7F), *range(0xC3, 0xE1), *range(0xE4, 0xF5)])
ASCII_LETTER = char_class([*range(0x41, 0x5B), *range(0x61, 0x7B)])
VISIBLE = char_class(range(0x21, 0x7F))
LATIN = char_class(x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7))  # letters after the byte C3
ASCII_MARK = char_class(x for x in range(0x21, 0x7F) if not chr(x).isalnum())


# --- words ---------------------------------------------------------------------------
def borders(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where byte-level pre-tokens certainly begin: at a blank before a visible character, at a mark after a letter, and
    before and after a single line break."""
    begin = np.zeros(len(data) + 1, bool)
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    if len(data) > 1:
        # the visible character has to be in the same text
        begin[:-2] = (data[:-1] == BLANK) & BODY[data[1:]] & ~first[1:-1]
        letter = ASCII_LETTER[data]
        letter[1:] |= (data[:-1] == 0xC3) & LATIN[data[1:]]
        begin[1:-1] |= letter[:-1] & ASCII_MARK[data[1:]]
        line = np.flatnonzero((data[1:-1] == 0x0A) & VISIBLE[data[:-2]] & BODY[data[2:]] & ~first[2:-1]) + 1
        begin[line] = begin[line + 1] = True
    return begin | first


class Words:
    """Cuts texts into words that one vocabulary encodes apart from each other.

    That holds for byte-level vocabularies without normalizer; for others, a whole text is one word. No cut falls into
    an added token.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        rules = json.loads(definition)
        self.added = [t["content"].encode() for t in rules.get("added_tokens") or []]
        self.apart = cuts_apart(definition)
        self.splitter = Tokenizer.from_str(definition).pre_tokenizer

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of all words and the end of the last."""
        begin = np.zeros(len(data) + 1, bool)
        begin[offsets] = True
        if not self.apart:
            return np.flatnonzero(begin)
        begin |= borders(data, offsets)
        raw = data.tobytes()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                begin[at + 1 : at + len(token)] = False
                at = raw.find(token, at + 1)
        begin[offsets] = True
        found = np.flatnonzero(begin)
        for k in np.flatnonzero(np.diff(found) > LONG_WORD).tolist():
            word = raw[found[k] : found[k + 1]]
            if any(token in word for token in self.added):
                continue
            starts = np.flatnonzero((data[found[k] : found[k + 1]] & 0xC0) != 0x80)  # of the characters
            begin[found[k] + starts[[a for _, (a, _) in self.splitter.pre_tokenize_str(word.decode())]]] = True
        return np.flatnonzero(begin)


@lru_cache(maxsize=1)
def words_of(definition: str) -> Words:
    return Words(definition)


def coded(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The number of each part between two cuts among the distinct parts, the most frequent first, and these."""
    edges = pa.py_buffer(cuts.astype(np.int32))
    parts = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, edges, pa.py_buffer(data)]).dictionary_encode()
    which = parts.indices.to_numpy()
    order = np.argsort(-np.bincount(which, minlength=len(parts.dictionary)), kind="stable")
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(len(order), dtype=np.int32)
    return number[which], parts.dictionary.take(pa.array(order))


def shrunk(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2**32, their bytes in planes."""
    import zstandard

    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def grown(packed: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(np.int64)


BLOCKS = "block bigint, rows array<{}>, sizes binary, numbers binary, keys array<{}>, key_bytes bigint"


def in_blocks(number: Callable[[pa.Array], tuple[np.ndarray, np.ndarray, pa.Array]], limit: int):
    """Blocks of rows: how many parts each has, the numbers of the parts, and the distinct parts of the block.

    ``number`` gives these for a column of values.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 36
        for batch in batches:
            rows, column = batch.column(0), batch.column(1)
            for low, high in slices(column, limit):
                sizes, numbers, keys = number(column.slice(low, high - low))
                own = pa.ListArray.from_arrays(pa.array([0, high - low], pa.int32()), rows.slice(low, high - low))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), own, pa.array([shrunk(sizes)], pa.binary()),
                     pa.array([shrunk(numbers)], pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                     pa.array([keys.nbytes], pa.int64())],
                    ["block", "rows", "sizes", "numbers", "keys", "key_bytes"],
                )
                block += 1

    return run


def bucketed(blocks: DataFrame) -> DataFrame:
    """Blocks written once to the shared folder, in buckets, so that what is joined to them comes to where they are."""
    spark = blocks.sparkSession
    path = new_path(spark, "blocks")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = blocks.write.format("parquet").option("path", path).option("compression", "zstd")
    writer.bucketBy(buckets, "block").saveAsTable(name)
    return spark.table(name)


def text_blocks(definition):
    """Blocks of texts with their distinct words."""

    def number(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        data, offsets = flat(column.to_pylist())
        if not len(data):
            return np.zeros(len(column), np.int64), np.empty(0, np.int64), pa.array([], pa.binary())
        cuts = words_of(definition.value).cuts(data, offsets)
        numbers, keys = coded(data, cuts)
        return np.diff(np.searchsorted(cuts, offsets)), numbers, keys

    return in_blocks(number, BLOCK_BYTES)


def id_blocks(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Blocks of lists of ids with their distinct ids."""
    ids = np.frombuffer(b"".join(x or b"" for x in column.to_pylist()), "<i4")
    keys, numbers = np.unique(ids, return_inverse=True)
    sizes = np.array([len(x or b"") // 4 for x in column.to_pylist()], np.int64)
    return sizes, numbers, pa.array(keys, pa.int32())


# --- the table of words ----------------------------------------------------------------
def shares_of(keys: pa.Array, many: int) -> np.ndarray:
    """The share of the table of words that each word belongs to."""
    edges = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset : keys.offset + len(keys) + 1].astype(np.int64)
    data = np.frombuffer(keys.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
    edges -= edges[0]
    return bucket_of(word_hashes(data, edges[:-1], edges[1:]), many)


def own_keys(column: pa.Array, k: int) -> pa.Array:
    """The keys of the k-th block of a list column."""
    return column.slice(k, 1).flatten()


def dealt(many: int):
    """(of, share, lengths, letters): the words of each block, packed for each share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for k in range(batch.num_rows):
                keys = own_keys(batch.column("keys"), k)
                if not len(keys):
                    continue
                which = shares_of(keys, many)
                order = np.argsort(which, kind="stable")
                shares, starts = np.unique(which[order], return_index=True)
                parts = [keys.take(pa.array(x)).to_pylist() for x in np.split(order, starts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("block")[k].as_py()] * len(shares), pa.int64()), pa.array(shares.astype(np.int32)),
                     pa.array([shrunk(np.fromiter(map(len, p), np.int64, len(p))) for p in parts], pa.binary()),
                     pa.array([press(b"".join(p)) for p in parts], pa.binary())],
                    ["of", "share", "lengths", "letters"],
                )

    return run


ENCODED = "of bigint, share int, sizes binary, ids binary"


def encoded(definition):
    """A share's distinct words encoded once each; every block gets the ids of its words back, in the order it sent them."""

    def run(table: pa.Table) -> pa.Table:
        import zstandard

        lengths = [grown(x) for x in table.column("lengths").to_pylist()]
        letters = [zstandard.ZstdDecompressor().decompress(x) for x in table.column("letters").to_pylist()]
        edges = np.append(0, np.cumsum(np.concatenate(lengths)))
        sent = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(b"".join(letters))])
        sent = sent.dictionary_encode()
        tokenizer, found = tokenizer_of(definition.value), []
        for low in range(0, len(sent.dictionary), BATCH):
            own = [w.decode() for w in sent.dictionary.slice(low, BATCH).to_pylist()]
            found += [np.array(x.ids, np.int64) for x in tokenizer.encode_batch_fast(own, add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], np.int64)
        pool, starts = np.concatenate(found), np.cumsum(sizes) - sizes
        rows, which = [], sent.indices.to_numpy()
        for own in np.split(which, np.cumsum([len(x) for x in lengths])[:-1]):
            ids, _ = gathered(pool, starts, sizes, own)
            rows.append((shrunk(sizes[own]), shrunk(ids)))
        packed, ids = zip(*rows, strict=True)
        return pa.Table.from_arrays(
            [table.column("of"), table.column("share"), pa.array(packed, pa.binary()), pa.array(ids, pa.binary())],
            ["of", "share", "sizes", "ids"],
        )

    return run


@lru_cache(maxsize=1)
def tokenizer_of(definition: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(definition)


@lru_cache(maxsize=1)
def pieces(definition: str) -> pa.Table:
    """(id, piece): the bytes each id stands for; as many rows as the vocabulary has, whatever the texts are."""
    from tokenizers import Tokenizer

    if (json.loads(definition).get("decoder") or {}).get("type") != "ByteLevel":
        raise ValueError("ids can be decoded for byte-level vocabularies only")
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
    hidden = [b for b in range(256) if b not in visible]
    byte = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
    found = []
    for token, i in Tokenizer.from_str(definition).get_vocab(with_added_tokens=True).items():
        raw = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        found.append((i, raw))
    ids, raw = zip(*found, strict=True)
    return pa.table({"id": pa.array(ids, pa.int32()), "piece": pa.array(raw, pa.binary())})


def gathered(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of the pool that a list of numbered ranges names, one after another, and where each range ends."""
    many = sizes[which]
    ends = np.cumsum(many)
    at = np.repeat(starts[which] - (ends - many), many) + np.arange(int(many.sum()))
    return pool[at], np.append(0, ends)


def texts_of(raw: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Bytes as texts, what is no UTF-8 replaced."""
    found = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))])
    try:
        return found.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode("utf-8", "replace") for x in found.to_pylist()], pa.string())


def unpacked(left: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Rows of a block, the number of parts before each row (one more for all), and the numbers of the parts."""
    rows = left.column("rows").combine_chunks()
    return rows.flatten(), np.append(0, np.cumsum(grown(left.column("sizes")[0].as_py()))), grown(left.column("numbers")[0].as_py())


def spelled(ids: np.ndarray, known: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that ids stand for by rows (id, piece) that hold each of them once, and where those of each end."""
    known = known.sort_by("id")
    raw = [x or b"" for x in known.column("piece").to_pylist()]
    sizes = np.array([len(x) for x in raw], np.int64)
    at = np.searchsorted(known.column("id").to_numpy(), ids)
    return gathered(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(sizes) - sizes, sizes, at)


def filled(definition, many: int):
    """A block's rows with the ids and the text of each; its distinct ids are joined with the pieces of the vocabulary."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, edges, numbers = unpacked(left)
        order = np.argsort(shares_of(own_keys(left.column("keys").combine_chunks(), 0), many), kind="stable")
        answers = right.sort_by("share")
        got = np.concatenate([*(grown(x) for x in answers.column("sizes").to_pylist()), np.empty(0, np.int64)])
        pool = np.concatenate([*(grown(x) for x in answers.column("ids").to_pylist()), np.empty(0, np.int64)])
        sizes, starts = np.empty_like(got), np.empty_like(got)
        sizes[order], starts[order] = got, np.cumsum(got) - got
        ids, ends = gathered(pool, starts, sizes, numbers)
        used = pa.table({"id": pa.array(np.unique(ids).astype(np.int32))})
        raw, stops = spelled(ids, used.join(pieces(definition.value), "id", join_type="left outer"))
        at = ends[edges]
        lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
        return pa.Table.from_arrays([rows, lists, texts_of(raw, stops[at])], ["row", "ids", "decoded"])

    return run


def joined(left: pa.Table, right: pa.Table) -> pa.Table:
    """A block's rows with the text of their ids."""
    rows, edges, numbers = unpacked(left)
    ids = left.column("keys").combine_chunks().flatten().to_numpy()[numbers]
    raw, stops = spelled(ids, right)
    return pa.Table.from_arrays([rows, texts_of(raw, stops[edges])], ["row", "decoded"])


def _own(docs: DataFrame, column, carry: list[str]) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), column.alias("value"))


def encode(docs: DataFrame, definition: str, text_col: str = "text", *, carry: list[str] | None = None) -> DataFrame:
    """row (the columns in ``carry``, or all), ids, and ``decoded``, the text of the ids, for every row of ``docs``.

    ``definition`` is the JSON of a byte-level vocabulary; ids are those of the library without special tokens added,
    truncation or padding. NULL and empty texts have no ids and decode to ''. Repeated rows and rows with NULL ids come
    back as often as they come in, no documents give no rows.

    Texts are cut into words in blocks, which are written down in buckets: a text is the numbers of its words there and
    does not move any more. The distinct words of a block go, packed, to the shares of one table of words, where each
    distinct word is encoded once; a block gets its ids back, and its distinct ids are joined with the pieces of the
    vocabulary where the block is, since that table is small and the same for all. A word in a third of all texts is one word in each block.
    """
    carry, spark = carry or docs.columns, docs.sparkSession
    shared = spark.sparkContext.broadcast(definition)
    own = _own(docs, F.col(f"`{text_col}`").cast("binary"), carry)
    kind = own.schema["row"].dataType.simpleString()
    blocks = bucketed(own.mapInArrow(text_blocks(shared), BLOCKS.format(kind, "binary")))
    held = blocks.agg(F.sum("key_bytes")).first()[0] or 0
    many = max(1, -(-held // SHARE_BYTES))
    sent = blocks.select("block", "keys").mapInArrow(dealt(many), "of bigint, share int, lengths binary, letters binary")
    answers = settled(sent.groupBy("share").applyInArrow(encoded(shared), ENCODED), "encoded-words")
    schema = T.StructType([own.schema["row"], *T.StructType.fromDDL("ids array<int>, decoded string").fields])
    return blocks.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(filled(shared, many), schema)


def decode(lists: DataFrame, definition: str, ids_col: str = "ids", *, carry: list[str] | None = None) -> DataFrame:
    """row (the columns in ``carry``, or all but the ids) and ``decoded``, the text of an array of ids.

    The distinct ids of a block of rows are joined with the pieces of the vocabulary. Bytes that are no UTF-8 become
    replacement characters; unknown ids and NULLs among the ids stand for nothing, NULL and empty lists give ''.
    """
    carry = carry or [c for c in lists.columns if c != ids_col]

    @F.pandas_udf("binary")
    def packed(values):
        return values.map(lambda x: None if x is None else np.array([-1 if i is None or i != i else i for i in x], "<i4").tobytes())

    own = _own(lists, packed(F.col(f"`{ids_col}`").cast("array<int>")), carry)
    kind = own.schema["row"].dataType.simpleString()
    blocks = bucketed(own.mapInArrow(in_blocks(id_blocks, BLOCK_BYTES), BLOCKS.format(kind, "int")))
    used = blocks.select(F.col("block").alias("of"), F.explode("keys").alias("id"))
    table = F.broadcast(lists.sparkSession.createDataFrame(pieces(definition)))  # a vocabulary
    found = used.join(table, "id", "left").select("of", "id", "piece")
    schema = T.StructType([own.schema["row"], T.StructField("decoded", T.StringType())])
    return blocks.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(joined, schema)


@query("op13_bpe_encoding")
def op13(spark, folder):
    found = encode(read(spark, folder, "documents"), vocabulary(), carry=["doc_id"])
    return found.select(
        "row.doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
