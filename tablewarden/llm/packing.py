"""Packing of tokenized documents into fixed-length sequences: dominance reduction, then best fit."""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewarden.llm.common import char_class, flat, query, read, settled, slices

END = 2  # id after each document
CACHE = 64 << 20  # bytes of distinct parts of text, with their ids, that a worker remembers
SHORT, ENTRY = 256, 130  # longest part that is remembered, and what an entry takes besides its bytes
TOGETHER, CALL = 500, 50  # distinct parts encoded as one text, and such texts to a call
SLICE = 2 << 20  # text whose arrays a task holds at once
# A blank before one of these bytes starts a new pre-token: no white space begins with them.
SOLID = char_class([*range(0x21, 0x7F), *range(0xC3, 0xE1), *range(0xE4, 0xF5)])
LETTER = char_class([*range(0x41, 0x5B), *range(0x61, 0x7B)])
PLAIN = char_class(range(0x21, 0x7F))
MARK = char_class(x for x in range(0x21, 0x7F) if not chr(x).isalnum() and chr(x) not in "<|>")  # not in special tokens
# One bit per class of a byte, so that a text is looked up once: bit 0 a blank, 1 solid, 2 a letter, 3 a mark, 4 a line break
CLASSES = (
    char_class([0x20]) | SOLID.astype(np.uint8) << 1 | LETTER.astype(np.uint8) << 2 | MARK.astype(np.uint8) << 3
    | char_class([0x0A]).astype(np.uint8) << 4
).astype(np.uint8).tobytes()
SOLID_BYTES, PLAIN_BYTES = (frozenset(np.flatnonzero(x).tolist()) for x in (SOLID, PLAIN))


# --- token ids -----------------------------------------------------------------------
def distinct(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Which distinct part each part between two cuts is, and the distinct parts."""
    edges = pa.py_buffer(cuts.astype(np.int32))
    parts = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, edges, pa.py_buffer(data)]).dictionary_encode()
    return parts.indices.to_numpy(), parts.dictionary.to_numpy(zero_copy_only=False).tolist()


def borders(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts are cut: before a blank that a solid byte follows, between a letter and a mark, around a single line
    break, and between texts."""
    kinds = np.frombuffer(data.tobytes().translate(CLASSES), np.uint8)
    cut = np.zeros(len(data) + 1, np.uint8)
    cut[1:-2] = kinds[1:-1] & kinds[2:] >> 1 & 1
    cut[1:-1] |= kinds[:-1] >> 2 & kinds[1:] >> 3 & 1
    line = np.flatnonzero(kinds[1:-1] & 16) + 1
    line = line[PLAIN[data[line - 1]] & PLAIN[data[line + 1]]]
    cut[line] = cut[line + 1] = True
    cut[offsets] = True
    return np.flatnonzero(cut)


def cuts_apart(definition: str) -> bool:
    """Whether a vocabulary encodes the parts of a text apart: a byte-level one that changes nothing before."""
    rules = json.loads(definition)
    before, model = rules.get("pre_tokenizer") or {}, rules["model"]
    return (
        before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        and not rules.get("normalizer") and model["type"] == "BPE" and not model.get("dropout")
        and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in rules.get("added_tokens") or [])
    )


class Encoder:
    """Ids of many texts by one byte-level vocabulary.

    Texts are cut where the vocabulary's pre-tokenizer always cuts, before a single blank that a visible character
    follows, between a letter and a mark and around a single line break, and every distinct part is encoded once. A
    vocabulary that is not byte-level encodes whole texts.
    """

    def __init__(self, definition: str, cache: int | None = None):
        from tokenizers import Tokenizer

        self.cache = CACHE if cache is None else cache
        self.tokenizer, self.known, self.held = Tokenizer.from_str(definition), {}, 0
        self.apart = cuts_apart(definition)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)  # each character of a token stands for one byte

    def learn(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """Ids of new parts, many as one text: parts that begin with a blank keep their borders one after another,
        parts of visible characters keep them with line breaks between."""
        blank, plain, other, learned = [], [], [], {}
        for w in parts:
            if w[0] == 0x20 and len(w) > 1 and w[1] in SOLID_BYTES:
                blank.append(w)
            elif w[0] in PLAIN_BYTES and w[-1] in PLAIN_BYTES:
                plain.append(w)
            else:
                other.append([w])
        groups = [(b"", blank[i : i + TOGETHER]) for i in range(0, len(blank), TOGETHER)]
        groups += [(b"\n", plain[i : i + TOGETHER]) for i in range(0, len(plain), TOGETHER)]
        groups += [(b"", g) for g in other]
        for low in range(0, len(groups), CALL):
            some = groups[low : low + CALL]
            texts = [mark.join(g).decode() for mark, g in some]
            for (mark, group), done in zip(some, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.array(done.ids, "<u4")
                sizes = np.fromiter(map(len, group), np.int64, len(group)) + len(mark)
                stops = np.cumsum(sizes)
                ends = np.concatenate([[0], np.cumsum(self.bytes[ids])])
                raw, begin = ids.tobytes(), 4 * np.searchsorted(ends, stops - sizes)
                close = 4 * np.searchsorted(ends, stops - len(mark))
                for word, i, j in zip(group, begin.tolist(), close.tolist(), strict=True):
                    learned[word] = raw[i:j]
        return learned

    def keep(self, learned: dict[bytes, bytes]) -> None:
        """Remember short parts, ``cache`` bytes of them at most."""
        learned = {word: ids for word, ids in learned.items() if len(word) <= SHORT}
        size = sum(map(len, learned)) + sum(map(len, learned.values())) + ENTRY * len(learned)
        if self.held + size <= self.cache:
            self.known.update(learned)
            self.held += size
        else:
            for word, ids in learned.items():
                self.held += len(word) + len(ids) + ENTRY
                if self.held > self.cache:
                    self.known, self.held = {}, len(word) + len(ids) + ENTRY
                self.known[word] = ids

    def whole(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast([(t or b"").decode() for t in texts], add_special_tokens=False)]
        return np.concatenate([*found, np.empty(0, "<u4")]), np.cumsum([0, *map(len, found)])

    def ids(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids start (one more entry for the end)."""
        if not self.apart:
            return self.whole(texts)
        data, offsets = flat(texts)
        if not len(data):
            return np.empty(0, "<u4"), np.zeros(len(offsets), np.int64)
        cuts = borders(data, offsets)
        which, words = distinct(data, cuts)
        found = list(map(self.known.get, words))
        new = [i for i, ids in enumerate(found) if ids is None]
        learned = self.learn([words[i] for i in new])
        for i in new:
            found[i] = learned[words[i]]
        self.keep(learned)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        pool = np.frombuffer(b"".join(found), "<u4")
        many = sizes[which]
        ends = np.cumsum(many)
        at = np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - many), many) + np.arange(many.sum())
        starts = np.r_[0, ends][np.searchsorted(cuts, offsets)]
        return pool[at], starts


@lru_cache(maxsize=1)
def encoder(definition: str, cache: int) -> Encoder:
    """The encoder of a worker; its tokenizer stays on the core of its task, where idle threads would only spin."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(definition, cache)


PIECES = "row {}, piece int, start bigint, length bigint, ids_crc32 bigint, block int, place bigint"


def cutter(definition, capacity: int, cache: int, slice_bytes: int):
    """Pieces of documents; ``place`` counts the pieces of one length within the task."""

    def cut(batches):
        encode, block = encoder(definition.value, cache).ids, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows, column = batch.column(0), batch.column(1)
            for low, high in slices(column, slice_bytes):
                ids, edges = encode(column.slice(low, high - low).to_pylist())
                of, piece, start, length, crc, place = [], [], [], [], [], []
                for d in range(high - low):
                    own = np.append(ids[edges[d] : edges[d + 1]], np.uint32(END)).astype("<u4")
                    stop = (len(own) - 1) % capacity + 1
                    begin = k = 0
                    while begin < len(own):
                        of.append(low + d)
                        piece.append(k)
                        start.append(begin)
                        length.append(stop - begin)
                        crc.append(zlib.crc32(own[begin:stop]))
                        place.append(seen[stop - begin])
                        seen[stop - begin] += 1
                        begin, stop, k = stop, stop + capacity, k + 1
                yield pa.RecordBatch.from_arrays(
                    [rows.take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(crc, pa.int64()), pa.array([block] * len(of), pa.int32()), pa.array(place, pa.int64())],
                    ["row", "piece", "start", "length", "ids_crc32", "block", "place"],
                )

    return cut


# --- the plan, from the number of pieces of each length -------------------------------
class Plan:
    """Where pieces go: pieces ``first .. first + n`` of a length fill one slot of sequences ``sequence ..`` in turn."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, {s: n for s, n in counts.items() if n}
        self.sizes = sorted(self.left)
        self.next = dict.fromkeys(counts, 0)
        self.sequences, self.rows = 0, []

    def place(self, size: int, n: int, sequence: int, offset: int) -> None:
        self.rows.append((size, self.next[size], n, sequence, offset))
        self.next[size] += n
        self.left[size] -= n
        if not self.left[size]:
            del self.left[size]
            self.sizes.remove(size)

    def fix(self, sizes: list[int], n: int) -> None:
        """Open n sequences that hold just these lengths."""
        offset = 0
        for size in sizes:
            self.place(size, n, self.sequences, offset)
            offset += size
        self.sequences += n

    def smallest(self, without: dict[int, int], n: int) -> list[int]:
        """The n smallest pieces besides those in ``without``."""
        found = []
        for size in self.sizes:
            free = self.left[size] - without.get(size, 0)
            found += [size] * min(max(free, 0), n - len(found))
            if len(found) == n:
                break
        return found

    def partner(self, size: int) -> int | None:
        """The largest other piece that fits beside one of this length."""
        at = bisect_left(self.sizes, self.capacity - size + 1) - 1
        while at >= 0:
            if self.left[self.sizes[at]] > (self.sizes[at] == size):
                return self.sizes[at]
            at -= 1
        return None

    def best_pair(self, size: int) -> int:
        """The largest sum of two other pieces that fit beside one of this length, 0 if no two fit."""
        room, best = self.capacity - size, 0
        for one in self.sizes:
            if self.left[one] <= (one == size):
                continue
            at = bisect_left(self.sizes, room - one + 1) - 1
            while at >= 0 and self.sizes[at] >= one:
                other = self.sizes[at]
                if self.left[other] > (other == size) + (other == one):
                    best = max(best, one + other)
                    break
                at -= 1
        return best

    def reduce(self) -> None:
        """Fix every set of one or two pieces that dominates all others with the same first piece, until none does.

        A set dominates another that can be parted so that each part is no larger than a piece of its own. So a piece
        goes alone if nothing fits beside it; with its largest partner if the two fill a sequence, if no two
        pieces fit beside it, or if no three do and the best two are together no larger than the partner.
        """
        changed = True
        while changed:
            changed = False
            for size in sorted(self.left, reverse=True):
                while size in self.left:
                    partner = self.partner(size)
                    if partner is None:
                        self.fix([size], self.left[size])
                        changed = True
                        break
                    room = self.capacity - size
                    others = self.smallest({size: 1}, 3)
                    full = partner == room
                    two = len(others) > 1 and sum(others[:2]) <= room
                    three = len(others) > 2 and sum(others) <= room
                    if not (full or not two or (not three and self.best_pair(size) <= partner)):
                        break
                    n = self.left[size] // 2 if partner == size else min(self.left[size], self.left[partner])
                    if not full:
                        n = 1  # what is left decides anew which set dominates
                        if two is False and partner != size:
                            n = min(self.left[size], self.left[partner])
                    self.fix([size, partner], n) if partner != size else self.pair(size, n)
                    changed = True

    def pair(self, size: int, n: int) -> None:
        self.place(size, n, self.sequences, 0)
        self.place(size, n, self.sequences, size)
        self.sequences += n

    def best_fit(self) -> None:
        """Best fit, longest first, for what is left; equal open sequences are handled as one range."""
        room: dict[int, list[tuple[int, int]]] = {}
        spaces: list[int] = []

        def add(space: int, sequence: int, n: int) -> None:
            if n and space:
                if space not in room:
                    insort(spaces, space)
                room.setdefault(space, []).append((sequence, n))

        for size in sorted(self.left, reverse=True):
            while size in self.left:
                at = bisect_left(spaces, size)
                if at < len(spaces):
                    space = spaces[at]
                    sequence, n = room[space].pop()
                    if not room[space]:
                        del room[space], spaces[at]
                else:
                    space, sequence = self.capacity, self.sequences
                    n = -(-self.left[size] // (self.capacity // size))
                    self.sequences += n
                each = space // size
                many, rest = divmod(min(self.left[size], n * each), each)
                for k in range(each if many else 0):
                    self.place(size, many, sequence, self.capacity - space + k * size)
                add(space - each * size, sequence, many)
                if rest:
                    for k in range(rest):
                        self.place(size, 1, sequence + many, self.capacity - space + k * size)
                    add(space - rest * size, sequence + many, 1)
                add(space, sequence + many + bool(rest), n - many - bool(rest))


def plan(counts: dict[int, int], capacity: int) -> Plan:
    found = Plan(counts, capacity)
    found.reduce()
    found.best_fit()
    return found


def pack(
    docs: DataFrame,
    definition: str,
    text_col: str = "text",
    *,
    capacity: int = 1024,
    carry: list[str] | None = None,
    cache: int = CACHE,
    slice_bytes: int = SLICE,
) -> DataFrame:
    """One row per piece: row (the columns in ``carry``, or all but the text), piece, start, length, ids_crc32, sequence_id, offset.

    ``definition`` is the JSON of a tokenizer. A document is its ids and the end id; NULL and empty texts are the end
    id alone. Only documents of more than ``capacity`` ids are cut, into full pieces after a first shorter one. Every row
    is packed, repeated rows and rows with a NULL id too; no documents give no rows. ``cache`` and ``slice_bytes`` bound
    the memory of a worker: what it remembers of encoded parts, and the text it turns into arrays at once.

    Only the number of pieces of each length reaches the driver, ``capacity`` numbers at most. Pieces of one length are
    alike, so reduction and best fit work on these counts, and each piece looks its slot up by its rank.
    """
    carry = carry or [c for c in docs.columns if c != text_col]
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    schema = PIECES.format(own.schema["row"].dataType.simpleString())
    pieces = settled(own.mapInArrow(cutter(shared, capacity, cache, slice_bytes), schema), "pieces")
    blocks = settled(pieces.groupBy("block", "length").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r.length: r.n for r in blocks.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = sorted(plan(counts, capacity).rows)
    sizes, first, _, sequence, offset = (np.array([r[i] for r in rows], np.int64) for i in range(5))
    edges = np.searchsorted(sizes, np.arange(capacity + 2))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(), rank.to_numpy()
        at = np.empty(len(length), np.int64)
        for size in np.unique(length):
            own = length == size
            low, high = edges[size], edges[size + 1]
            at[own] = low + np.searchsorted(first[low:high], rank[own], "right") - 1
        return pd.DataFrame({"sequence_id": sequence[at] + rank - first[at], "offset": offset[at]})

    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("block", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["block", "length"]).withColumn("slot", slot("length", F.col("before") + F.col("place")))
    return ranked.select("row", "piece", "start", "length", "ids_crc32", "slot.sequence_id", "slot.offset")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The JSON of one of the installed public tokenizers."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@query("op8_best_fit_packing")
def op8(spark, folder):
    found = pack(read(spark, folder, "documents"), vocabulary(), carry=["doc_id"])
    return found.select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
