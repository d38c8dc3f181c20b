"""Token ids of documents as files of canonical Huffman codes, and back."""

from __future__ import annotations

import re
import string
import struct
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._work import Shelf, name

#: Ids are counted, coded and decoded so many at a time inside a task.
CHUNK = 1 << 20
#: Bytes of text that are encoded together; a longer text goes by itself, whole.
TEXT_BYTES = 1 << 24
#: Words whose ids a task remembers, twice over, and the longest of them in characters.
WORDS, WORD_CHARS = 700_000, 32


@dataclass(frozen=True)
class Layout:
    """The shape of the files. None of the numbers changes what is read back."""

    limit: int = 18  # the longest code, in bits, 24 at most; 2 ** limit must not be below the number of ids
    block: int = 1 << 14  # ids of a block at most; a block is decoded without any other
    stride: int = 256  # ids from one checkpoint to the next
    part: int = 1 << 22  # ids of a part, about
    most_parts: int = 4096


PIECE = "struct<doc_id: bigint, first: bigint, piece: int, last: boolean, n: int, bytes: int>"
BLOCKS = f"part int, block int, n bigint, pieces array<{PIECE}>, marks binary, payload binary"


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text",
              by_word: bool = False, layout: Layout = Layout()) -> None:
    """Write the token ids of every document below `path`, in ascending order of the key.

    `tokenizer` is the content of a tokenizer's JSON file; it is sent to the tasks, whose size does not
    grow with the documents. Each document's ids end with `end_id`. With `by_word`, for tokenizers that
    drop white space and join nothing across it, a text is cut at ASCII white space and the library
    encodes words that a task has not met lately; the ids are those of the whole text.

    The texts are encoded once, into a table that is removed when the files are written; it is read to
    count the ids and to code them. `<path>/code` holds the length of each id's code, which is all that a canonical
    code needs; `<path>/blocks` holds the blocks, part after part. A part is a range of keys. What goes
    through the driver is one count per id of the vocabulary and one bound per part.

    Null keys come first. Documents of equal keys stand in the order in which they are read; they are
    spread over as many parts as their share asks for. A null or empty text has the end id alone. A long
    text is cut into pieces of `layout.block` ids. Repeated rows are written again. Of no documents there
    is an empty file. Columns other than key and text are not read, whatever their names.
    """
    spark = docs.sparkSession
    shelf = Shelf(spark, "token-ids")
    kind = "<u2" if max(_words(tokenizer).size, end_id + 1) <= 1 << 16 else "<u4"
    shared = spark.sparkContext.broadcast((tokenizer, end_id, by_word, kind))
    rows = docs.select(name(key).cast("long").alias("doc_id"), name(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    raw = shelf.put(rows.mapInArrow(_encoded(shared), "doc_id bigint, row bigint, ids binary"), compression="zstd")
    counted = raw.select("ids").mapInArrow(_counted(kind), "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    counts = counted.orderBy("id").toPandas()  # a row per id of the vocabulary at most
    ids, n = counts["id"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    lengths = code_lengths(n, layout.limit)
    code = spark.createDataFrame(list(zip(ids.tolist(), lengths.tolist(), strict=True)), "id int, length int")
    code.coalesce(1).write.parquet(f"{path}/code")
    parts = int(min(max(-(-int(n.sum()) // layout.part), 1), layout.most_parts))
    bounds = np.array(_bounds(raw, parts), np.int64)
    book = spark.sparkContext.broadcast(_dense(ids, lengths))
    coded = raw.mapInArrow(
        _coded(kind, book, bounds, layout),
        "part int, doc_id bigint, row bigint, piece int, last boolean, first int, n int, marks binary, payload binary",
    )
    in_order = coded.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "doc_id", "row", "piece")
    # Codes do not compress any further.
    in_order.mapInArrow(_blocks(layout.block), BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")
    shelf.drop(raw)


def read_ids(spark: SparkSession, path: str, layout: Layout = Layout()) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document that `write_ids` wrote, from the files.

    `start` counts the ids of all documents before it, `n_tokens` its own with the end id, and
    `ids_crc32` is the checksum of the ids as little-endian unsigned 32-bit integers. Blocks are decoded
    apart from each other; a document that goes over several blocks is put together from the
    checksums of its pieces.
    """
    shelf = Shelf(spark, "token-pieces")
    pieces = decoded(spark, path, layout, _checked, "part int, doc_id bigint, first bigint, piece int, whole boolean, n int, crc bigint")
    return shelf.last(_placed(spark, path, shelf.put(pieces)))


def read_tokens(spark: SparkSession, path: str, layout: Layout = Layout()) -> DataFrame:
    """(part, first, doc_id, piece, ids): the ids themselves, a row per piece of at most `layout.block` ids.

    Sorted by (part, first, piece) the pieces give the documents in the order of the files.
    """
    return decoded(spark, path, layout, _listed, "part int, doc_id bigint, first bigint, piece int, ids array<int>")


def decoded(spark: SparkSession, path: str, layout: Layout, each, schema: str) -> DataFrame:
    code = spark.read.schema("id int, length int").parquet(f"{path}/code").orderBy("id").toPandas()
    ids, lengths = code["id"].to_numpy(np.int64), code["length"].to_numpy(np.int64)
    table = spark.sparkContext.broadcast(decoding_table(ids, lengths))
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                yield each(batch.slice(at, 64), *_decode(batch.slice(at, 64), table.value, layout.stride))

    return blocks.mapInArrow(read, schema)


def _placed(spark: SparkSession, path: str, pieces: DataFrame) -> DataFrame:
    """Documents from their pieces, with the number of ids before them."""
    totals = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n").alias("total"))
    # A row per part, of which there are at most `most_parts`.
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    # `whole` is false for the pieces of a document of several; only those are gathered.
    one = pieces.filter("whole").select("part", "doc_id", "first", F.col("n").cast("long").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    several = (
        pieces.filter("not whole")
        .groupBy("part", "first")
        .applyInArrow(_join_pieces, "part int, doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint")
    )
    return (
        one.unionByName(several)
        .join(F.broadcast(parts), "part")
        .select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
    )


# --- token ids


#: Letters of Latin-1, and what follows them from a sign of ASCII on that is none.
_STEM = re.compile("([A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([\0-@\\[-`{-\x7f].*)", re.DOTALL)


class _Words(dict):
    """The ids of words, encoded by the library when they are first met, as bytes.

    When WORDS are held, they become the older half, from which a word that is met again comes back.
    """

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = t = Tokenizer.from_str(tokenizer)
        self._model = t.model
        self.size = t.get_vocab_size()
        self.special = [a.content for a in t.get_added_tokens_decoder().values()]
        self.kind = "<u4"
        self._older: dict[str, bytes] = {}
        self._table = self._letters()
        #: Whether upper case makes no difference outside special tokens.
        self.folds = bool(self._table) and all(self._table[ord(c)] == self._table[ord(c.lower())] for c in string.ascii_uppercase)

    def _letters(self) -> dict[int, str] | None:
        """What reaches the model of each letter of Latin-1, upper case included; None unless a run of letters reaches it as one piece."""
        t = self.tokenizer
        if not t.normalizer or not t.pre_tokenizer:
            return None
        pieces = lambda text: [p for p, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(text))]
        letters = [c for c in map(chr, range(0x100)) if c.isalpha()]
        table = {c: "".join(pieces(c)) for c in letters}
        if pieces("".join(letters)) != ["".join(table.values())]:
            return None
        return {ord(c): piece for c, piece in table.items()}

    def __missing__(self, word: str) -> bytes:
        raw = self._older.get(word)
        if raw is None:
            raw = self._fresh(word)
        if len(word) <= WORD_CHARS:
            if len(self) >= WORDS:
                self._older = dict(self)
                self.clear()
            self[word] = raw
        return raw

    def _fresh(self, word: str) -> bytes:
        if self._table and word:
            if word.isalpha() and max(word) <= "\xff":
                # No sign of Latin-1 changes the one before it, so the letters can be put in one by one.
                return self.packed([t.id for t in self._model.tokenize(word.translate(self._table))])
            stem = _STEM.fullmatch(word)
            if stem:
                return self[stem[1]] + self[stem[2]]
        return self.packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def use(self, kind: str) -> None:
        """Hold ids as numbers of this kind."""
        if kind != self.kind:
            self.kind = kind
            self.clear()
            self._older = {}

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.kind == '<u2' else 'I'}", *ids)


@lru_cache(1)
def _words(tokenizer: str) -> _Words:
    return _Words(tokenizer)


def token_ids(texts: pa.Array, tokenizer: str, end_id: int, by_word: bool, kind: str) -> pa.Array:
    """The ids of each text and the end id, as little-endian unsigned integers."""
    words = _words(tokenizer)
    words.use(kind)
    end = words.packed([end_id])
    if not by_word:
        of_text = lambda t: words.packed(words.tokenizer.encode(t, add_special_tokens=False).ids) if t else b""
        return pa.array([of_text(t) + end for t in texts.to_pylist()], pa.binary())
    texts = texts.fill_null("")
    # Special tokens are looked for before texts are put in lower case.
    if words.folds and not any(pc.any(pc.match_substring(texts, s, ignore_case=True)).as_py() for s in words.special):
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    # Each different word once, and the end behind the last word of each text.
    raws = [*map(words.__getitem__, coded.dictionary.to_pylist()), end]
    ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    order = np.insert(coded.indices.to_numpy().astype(np.int64), ends[1:], len(raws) - 1)
    size = np.fromiter(map(len, raws), np.int64, len(raws)) // np.dtype(kind).itemsize
    n = size[order]
    total = np.cumsum(n)
    flat = np.frombuffer(b"".join(raws), kind)
    ids = flat[np.arange(int(total[-1])) + np.repeat((np.cumsum(size) - size)[order] - (total - n), n)]
    last = total[ends[1:] + np.arange(len(texts))]
    offsets = np.concatenate([np.zeros(1, np.int64), last]) * ids.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)]).cast(pa.binary())


def _encoded(shared):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            size = pc.binary_length(text).fill_null(0).to_numpy(zero_copy_only=False)
            # Some texts at a time, so that the ids of a batch of long texts are not held at once.
            cuts = np.flatnonzero(np.diff(np.cumsum(size) // TEXT_BYTES, prepend=-1, append=-1))
            for first, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                cells = [batch.column(c).slice(first, end - first) for c in ("doc_id", "row")]
                yield pa.RecordBatch.from_arrays([*cells, token_ids(text.slice(first, end - first), *shared.value)], names=["doc_id", "row", "ids"])

    return encode


def _gathered(raws: pa.Array, kind: str) -> Iterator[tuple[list[int], list[bytes]]]:
    """Documents together, until they have CHUNK ids."""
    at, held, size = [], [], 0
    width = np.dtype(kind).itemsize
    for i in range(len(raws)):
        raw = raws[i].as_py()
        at.append(i)
        held.append(raw)
        size += len(raw) // width
        if size >= CHUNK:
            yield at, held
            at, held, size = [], [], 0
    if held:
        yield at, held


def _counted(kind: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for _, raws in _gathered(batch.column("ids"), kind):
                new = np.bincount(np.frombuffer(b"".join(raws), kind), minlength=len(total))
                new[: len(total)] += total
                total = new
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["id", "n"])

    return count


# --- the code


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Lengths, at most `limit`, of an optimal prefix code: package-merge.

    Every one of `limit` rounds merges the ids, in order of their counts, with the pairs of the round
    before. The first 2n - 2 entries of the last round are taken, and of each round below the pairs that
    went into them; an id's code is as long as it was taken.
    """
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids need codes of more than {limit} bits")
    order = np.argsort(counts, kind="stable")
    single = counts[order].astype(np.int64)
    pairs = np.zeros(0, np.int64)
    rounds = []
    for _ in range(limit):
        both = np.concatenate([single, pairs])
        merged = np.argsort(both, kind="stable")
        rounds.append(merged < n)
        sums = both[merged]
        pairs = sums[: len(sums) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths = np.zeros(n, np.int64)
    taken = 2 * n - 2
    for is_single in reversed(rounds):
        singles = np.count_nonzero(is_single[:taken])
        lengths[order[:singles]] += 1
        taken = 2 * (taken - singles)
    return lengths


def canonical_codes(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids' order in the code, by length and then id, and the code of each in that order."""
    order = np.lexsort([ids, lengths])
    longest = int(lengths.max(initial=1))
    # Left-justified, each code starts where the one before it ends.
    ends = np.cumsum(np.int64(1) << (longest - lengths[order]))
    starts = np.concatenate([np.zeros(1, np.int64), ends])[: len(order)]
    return order, starts >> (longest - lengths[order])


def _dense(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code and length by id."""
    codes, sizes = np.zeros(int(ids.max(initial=0)) + 1, np.uint64), np.zeros(int(ids.max(initial=0)) + 1, np.int32)
    order, code = canonical_codes(ids, lengths)
    codes[ids[order]], sizes[ids] = code.astype(np.uint64), lengths
    return codes, sizes


def decoding_table(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For every number of as many bits as the longest code: the id whose code it begins with, and that
    code's length in the lowest five bits."""
    longest = int(lengths.max(initial=1))
    order, _ = canonical_codes(ids, lengths)
    entries = (ids[order].astype(np.uint32) << np.uint32(5)) | lengths[order].astype(np.uint32)
    table = np.zeros(1 << longest, np.uint32)
    filled = np.repeat(entries, np.int64(1) << (longest - lengths[order]))
    table[: len(filled)] = filled
    return table, longest


# --- writing


def _bounds(rows: DataFrame, parts: int) -> list[int]:
    """The keys at which a new part begins; a frequent key stands several times. Null is least."""
    if parts == 1:
        return []
    least = F.lit(-(1 << 63))
    shares = [k / parts for k in range(1, parts)]
    found = rows.agg(F.percentile_approx(F.coalesce("doc_id", least), shares, F.lit(16 * max(parts, 1024))).alias("b")).first()["b"]
    return found or []


def _coded(kind: str, book, bounds: np.ndarray, layout: Layout):
    names = ["part", "doc_id", "row", "piece", "last", "first", "n", "marks", "payload"]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, sizes = book.value
        for batch in batches:
            keys = batch.column("doc_id")
            number = keys.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)
            least, most = np.searchsorted(bounds, number, "left"), np.searchsorted(bounds, number, "right")
            # A key that is a bound may go to any part around it: its rows take turns.
            row = batch.column("row").to_numpy()
            part = least + row % (most - least + 1)
            for at, raws in _gathered(batch.column("ids"), kind):
                doc, piece, last, first, n, marks, payload = _pieces(raws, kind, codes, sizes, layout)
                doc = np.array(at)[doc]
                cells = [pa.array(part[doc], pa.int32()), keys.take(pa.array(doc)), pa.array(row[doc]), pa.array(piece, pa.int32()),
                         pa.array(last), pa.array(first, pa.int32()), pa.array(n, pa.int32()), pa.array(marks, pa.binary()), pa.array(payload, pa.binary())]
                yield pa.RecordBatch.from_arrays(cells, names=names)

    return code


def _pieces(raws: Sequence[bytes], kind: str, codes: np.ndarray, sizes: np.ndarray, layout: Layout):
    """The documents' pieces: document, number, whether it is the last, ids before it in the document,
    ids, checkpoints and code of each. A piece's code begins at a byte."""
    ids = np.frombuffer(b"".join(raws), kind)
    per_doc = np.array([len(r) for r in raws], np.int64) // ids.itemsize
    pieces = -(-per_doc // layout.block)
    doc = np.repeat(np.arange(len(raws)), pieces)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    last = number == pieces[doc] - 1
    n = np.where(last, per_doc[doc] - number * layout.block, layout.block)
    begin = np.cumsum(n) - n
    # Positions are counted in bits; 32-bit numbers, where they are enough, are half the work.
    whole = np.int32 if len(ids) < 1 << 26 else np.int64
    size = sizes[ids].astype(whole, copy=False)
    before = np.cumsum(size, dtype=whole) - size
    used = before[begin + n - 1] + size[begin + n - 1] - before[begin]
    bytes_ = -(-used // 8)
    offset = np.cumsum(bytes_, dtype=np.int64) - bytes_
    position = before + np.repeat((8 * offset - before[begin]).astype(whole), n)
    # A code lies in one word of 64 bits, or goes over into the next; codes that share a word do not overlap.
    left = 64 - (position & 63) - size
    code = codes[ids]
    over = np.flatnonzero(left < 0)
    word = position >> 6
    firsts = np.flatnonzero(np.diff(word, prepend=-1))
    out = np.zeros(int(offset[-1] + bytes_[-1]) // 8 + 2, np.uint64)
    shifted = code << np.maximum(left, 0).astype(np.uint64)
    shifted[over] = code[over] >> (-left[over]).astype(np.uint64)
    out[word[firsts]] = np.add.reduceat(shifted, firsts)
    out[word[over] + 1] += code[over] << (64 + left[over]).astype(np.uint64)
    raw = out.astype(">u8").tobytes()
    strides = -(-n // layout.stride)
    within = np.arange(int(strides.sum())) - np.repeat(np.cumsum(strides) - strides, strides)
    marked = np.repeat(begin, strides) + within * layout.stride
    marks = (before[marked] - np.repeat(before[begin], strides)).astype("<u4").tobytes()
    ends = np.cumsum(-(-n // layout.stride)) * 4
    return (
        doc, number, last, number * layout.block, n,
        [marks[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)],
        [raw[a : a + b] for a, b in zip(offset.tolist(), bytes_.tolist(), strict=True)],
    )


def _blocks(most: int):
    names = ["part", "block", "n", "pieces", "marks", "payload"]
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("first", pa.int64()), ("piece", pa.int32()), ("last", pa.bool_()), ("n", pa.int32()), ("bytes", pa.int32())]))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, held, marks, payload, n, done = None, 0, [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            cells = [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([n], pa.int64()), pa.array([held], kind),
                     pa.array([b"".join(marks)], pa.binary()), pa.array([b"".join(payload)], pa.binary())]
            return pa.RecordBatch.from_arrays(cells, names=names)

        for batch in batches:
            for p, doc_id, _, piece, last, first, size, mark, code in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and (p != part or n + size > most):
                    yield flush()
                    block, held, marks, payload, n = block + 1, [], [], [], 0
                if p != part:
                    part, block, done = p, 0, 0
                held.append((doc_id, done - first, piece, last, size, len(code)))
                marks.append(mark)
                payload.append(code)
                n += size
                done += size
        if held:
            yield flush()

    return gather


# --- reading


def _decode(batch: pa.RecordBatch, coded: tuple[np.ndarray, int], stride: int):
    """The ids of the blocks, one after the other, and (block, piece fields) of their pieces in the same order.

    The stretches from one checkpoint to the next are decoded side by side, one id of each at a step.
    """
    table, longest = coded
    pieces = batch.column("pieces")
    owner = np.repeat(np.arange(batch.num_rows), np.diff(pieces.offsets.to_numpy()))
    fields = pieces.flatten()
    n = fields.field("n").to_numpy().astype(np.int64)
    size = fields.field("bytes").to_numpy().astype(np.int64)
    raw = np.frombuffer(b"".join([*batch.column("payload").to_pylist(), bytes(8)]), np.uint8).astype(np.uint32)
    # The 32 bits that begin at each byte.
    window = (raw[:-3] << np.uint32(24)) | (raw[1:-2] << np.uint32(16)) | (raw[2:-1] << np.uint32(8)) | raw[3:]
    marks = np.frombuffer(b"".join(batch.column("marks").to_pylist()), "<u4").astype(np.int64)
    lanes = -(-n // stride)
    within = np.arange(len(marks)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    at = marks + np.repeat(8 * (np.cumsum(size) - size), lanes)
    left = np.minimum(np.repeat(n, lanes) - within * stride, stride)
    order = np.argsort(-left, kind="stable")
    at, falling = at[order], left[order]
    # A row per step; a lane's ids stand in a column.
    steps = np.zeros((int(falling[0]) if len(left) else 0, len(left)), "<u4")
    alive = np.searchsorted(-falling, -np.arange(len(steps)), "left")
    for step, m in enumerate(alive.tolist()):
        p = at[:m]
        entry = table[(window[p >> 3] << (p & 7).astype(np.uint32)) >> np.uint32(32 - longest)]
        steps[step, :m] = entry >> np.uint32(5)
        p += entry & np.uint32(31)
    columns = np.empty_like(steps.T, order="C")
    columns[order] = steps.T
    out = columns[np.arange(len(steps)) < left[:, None]]
    return out, owner, fields, n


def _checked(batch: pa.RecordBatch, ids: np.ndarray, owner: np.ndarray, fields: pa.StructArray, n: np.ndarray) -> pa.RecordBatch:
    ends = (4 * np.cumsum(n)).tolist()
    raw = memoryview(ids.tobytes())
    crc = [zlib.crc32(raw[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    piece, last = fields.field("piece"), fields.field("last").to_numpy(zero_copy_only=False)
    cells = [batch.column("part").take(pa.array(owner)), fields.field("doc_id"), fields.field("first"), piece,
             pa.array((piece.to_numpy() == 0) & last), fields.field("n"), pa.array(crc, pa.int64())]
    return pa.RecordBatch.from_arrays(cells, names=["part", "doc_id", "first", "piece", "whole", "n", "crc"])


def _listed(batch: pa.RecordBatch, ids: np.ndarray, owner: np.ndarray, fields: pa.StructArray, n: np.ndarray) -> pa.RecordBatch:
    offsets = np.concatenate([np.zeros(1, np.int32), np.cumsum(n).astype(np.int32)])
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
    cells = [batch.column("part").take(pa.array(owner)), fields.field("doc_id"), fields.field("first"), fields.field("piece"), lists]
    return pa.RecordBatch.from_arrays(cells, names=["part", "doc_id", "first", "piece", "ids"])


# --- checksums of parts

#: The polynomial of CRC-32, lowest power first: a fixed value.
CRC_POLYNOMIAL = 0xEDB88320


def _applied(columns: Sequence[int], vector: int) -> int:
    out = 0
    for i, column in enumerate(columns):
        if vector >> i & 1:
            out ^= column
    return out


@lru_cache(64)
def _zeros(power: int) -> tuple[int, ...]:
    """What 2 ** power zero bits do to a checksum, as the columns of a matrix over two elements."""
    if power == 0:
        return (CRC_POLYNOMIAL, *(1 << i for i in range(31)))
    half = _zeros(power - 1)
    return tuple(_applied(half, column) for column in half)


def joined_crc(first: int, second: int, n: int) -> int:
    """The checksum of two byte strings, one after the other, from theirs and the second's `n` bytes."""
    bits, power = 8 * n, 0
    while bits:
        if bits & 1:
            first = _applied(_zeros(power), first)
        bits, power = bits >> 1, power + 1
    return first ^ second


def _join_pieces(pieces: pa.Table) -> pa.Table:
    rows = sorted(pieces.select(["piece", "n", "crc"]).to_pylist(), key=lambda r: r["piece"])
    crc, n = 0, 0
    for r in rows:
        crc, n = joined_crc(crc, r["crc"], 4 * r["n"]), n + r["n"]
    head = pieces.slice(0, 1)
    return pa.table({"part": head["part"], "doc_id": head["doc_id"], "first": head["first"], "n_tokens": pa.array([n], pa.int64()), "ids_crc32": pa.array([crc], pa.int64())})


def json_of(path: str) -> str:
    """The content of a tokenizer's file."""
    return Path(path).read_text(encoding="utf-8")
