"""BPE encoding and decoding over a distinct-word table.

Spark splits every text into the words (pre-tokens) of the byte-level pattern. Texts are taken in
blocks of some megabytes; a block is the list of its distinct words and, for each text, the places
of its words in that list. The words of all blocks are shuffled by word, each distinct word is
encoded once and its ids are joined to their pieces, which decodes it, and ids and pieces are
joined back to the places of each block. ``decode`` is the same join for whole lists of ids.

A word has one row in a block however often it occurs, so the commonest word has as many rows as
there are blocks. A block's list is bounded by the block's size. Places are packed by byte planes
and compressed, so a text moves once and in less than its own size.

Both passes over the texts cut the same blocks, so ``docs`` should be a stored table: the size
of each block's list is compared, and a difference raises an error.

Null texts are empty texts. Empty texts have no ids. A special token's string in a text is that
token, as in the library. Repeated rows are each encoded. An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Characters of text after which a block ends.
BLOCK_CHARS = 24 << 20


def word_pattern(special: list[str]) -> str:
    """The byte-level words as a Java pattern; special tokens stand alone."""
    quoted = [r"\Q" + s + r"\E" for s in special]
    no_special = "".join(f"(?!{s})" for s in quoted)
    space, other = r"\p{IsWhite_Space}", r"[^\p{IsWhite_Space}\p{L}\p{N}]"
    return "|".join(
        [
            *quoted, "'s|'t|'re|'ve|'m|'ll|'d", r" ?\p{L}+", r" ?\p{N}+", f" ?(?:{no_special}{other})+",
            rf"{space}+(?!{no_special}[^\p{{IsWhite_Space}}])", f"{space}+",
        ]
    )


def pieces(path: str) -> list[tuple[int, bytes]]:
    """(id, bytes) of every token of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    letters = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}
    found = {i: bytes(letters[c] for c in token) for token, i in spec["model"]["vocab"].items()}
    return sorted((found | {t["id"]: t["content"].encode() for t in spec["added_tokens"]}).items())


@lru_cache(maxsize=1)
def _loaded(path: str) -> tuple:
    """The library's tokenizer and the bytes of each id, loaded once by a worker process.

    A task has one core, so the library starts no threads of its own.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), pa.array([p for _, p in pieces(path)], pa.binary())


def _special(path: str) -> list[str]:
    with open(path, encoding="utf-8") as file:
        return [t["content"] for t in json.load(file)["added_tokens"]]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, pa.Array, np.ndarray, np.ndarray]]:
    """(block, ids, distinct words by falling count, words of each text, their places)."""
    # of a text its words' places are held, and each word once; the texts themselves are not
    ids, counts, coded, words = [], [], [], pa.array([], pa.string())
    size = seq = part = 0

    def hold(piece: pa.RecordBatch) -> None:
        nonlocal words, part
        part = piece["part"][0].as_py()
        ids.extend(piece["_id"].to_pylist())
        counts.append(pc.list_value_length(piece["words"]).to_numpy(zero_copy_only=False))
        found = piece["words"].flatten().dictionary_encode()
        at = np.array(pc.fill_null(pc.index_in(found.dictionary, value_set=words), -1))
        fresh = at < 0
        at[fresh] = len(words) + np.arange(fresh.sum())
        words = pa.concat_arrays([words, found.dictionary.filter(pa.array(fresh))])
        coded.append(at[found.indices.to_numpy()])

    def block():
        nonlocal ids, counts, coded, words
        places = np.concatenate(coded)
        order = np.argsort(-np.bincount(places, minlength=len(words)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        found = (part << 24) + seq, ids, words.take(pa.array(order)), np.concatenate(counts), rank[places]
        ids, counts, coded, words = [], [], [], pa.array([], pa.string())
        pa.default_memory_pool().release_unused()
        return found

    for batch in batches:
        if not len(batch):
            continue
        # a batch may hold many texts, so it is cut where a block is full
        upto = size + np.cumsum(batch["chars"].to_numpy())
        begin = 0
        while begin < len(batch):
            end = min(len(batch), begin + 1 + int(np.searchsorted(upto[begin:], BLOCK_CHARS)))
            hold(batch.slice(begin, end - begin))
            if upto[end - 1] >= BLOCK_CHARS:
                yield block()
                seq, upto = seq + 1, upto - upto[end - 1]
            begin = end
        size = int(upto[-1])
    if counts:
        yield block()


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block, _, words, _, _ in _cut(batches):
        for begin in range(0, len(words), 50_000):
            part = words.slice(begin, 50_000)
            place = np.arange(begin, begin + len(part), dtype=np.int32)
            yield pa.RecordBatch.from_arrays([part, pa.array(np.full(len(part), block)), pa.array(place)], ["word", "block", "place"])


def _planes(values: np.ndarray) -> bytes:
    """Values below 2^32 with their lowest bytes first, then the next ones, and so on."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _read_planes(raw: bytes, at: int, n: int) -> tuple[np.ndarray, int]:
    """``n`` values written at ``at`` by _planes, and where they end."""
    planes = np.frombuffer(raw, np.uint8, 4 * n, at).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel(), at + 4 * n


_ROWS = "block long, kind int, size int, packed binary, raw long"


def _packed(block: int, kind: int, size: int, raw: bytes) -> list:
    """One row's columns, in the order of _ROWS."""
    packed = pa.compress(raw, codec="zstd", asbytes=True)
    types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
    return [pa.array([x], t) for x, t in zip((block, kind, size, packed, len(raw)), types)]


_NAMES = ["block", "kind", "size", "packed", "raw"]
#: Words that a task holds before it packs them by block.
HELD_WORDS = 150_000


def _encode_words(tokenizer: str):
    """Rows (word, block, place), sorted by word, as packed rows (block, places, ids, decoded)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, piece = _loaded(tokenizer)
        held: list[pa.RecordBatch] = []
        last: tuple[str, list[int]] | None = None
        for batch in batches:
            if not len(batch):
                continue
            coded = batch["word"].dictionary_encode()
            words = coded.dictionary.to_pylist()
            # a word's rows may go on in the next batch
            known = [last[1]] if last and last[0] == words[0] else []
            ids = known + [x.ids for x in library.encode_batch_fast(words[len(known) :], add_special_tokens=False)]
            last = (words[-1], ids[-1])
            ids = pa.array(ids, pa.list_(pa.int32()))
            # decoded through the join of ids to pieces, whose table is the vocabulary
            text = _joined(piece, ids.flatten(), ids.offsets.to_numpy(), None)
            held.append(
                pa.RecordBatch.from_arrays([batch["block"], batch["place"], ids.take(coded.indices), text.take(coded.indices)], ["block", "place", "ids", "decoded"])
            )
            if sum(map(len, held)) >= HELD_WORDS:
                yield from _packed_words(held)
                held = []
        if held:
            yield from _packed_words(held)

    return run


def _packed_words(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(held).sort_by([("block", "ascending"), ("place", "ascending")]).combine_chunks()
    blocks = table["block"].to_numpy()
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(blocks)) + 1, [len(blocks)]))
    for a, b in zip(cuts, cuts[1:]):
        part = table.slice(a, b - a).combine_chunks()
        ids, text = part["ids"].chunk(0), part["decoded"].chunk(0)
        places = part["place"].to_numpy()
        raw = b"".join(
            (_planes(np.diff(places, prepend=0)), _planes(_lengths(ids, pa.int32())), _planes(_lengths(text, None)),
             _planes(ids.flatten().to_numpy()), b"".join(text.to_pylist()))
        )
        yield pa.RecordBatch.from_arrays(_packed(int(blocks[a]), 0, len(part), raw), _NAMES)


def _block_places(kind: pa.DataType):
    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, words, counts, at in _cut(batches):
            columns = _packed(block, 1, len(words), _planes(counts) + _planes(at))
            yield pa.RecordBatch.from_arrays([*columns, pa.array([ids], pa.list_(kind))], [*_NAMES, "texts"])

    return places


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of every row; ``tokenizer`` is the file's path on every executor."""
    spark = docs.sparkSession
    named = docs.select(
        F.col(id_col).alias("_id"), F.coalesce(F.length(text_col), F.lit(0)).alias("chars"),
        F.coalesce(F.regexp_extract_all(F.col(text_col), F.lit(word_pattern(_special(tokenizer))), F.lit(0)), F.array().cast("array<string>")).alias("words"),
        F.spark_partition_id().cast("long").alias("part"),
    )
    id_type = named.schema["_id"].dataType.simpleString()

    rows = named.mapInArrow(_block_words, "word string, block long, place int")
    listed = (
        rows.repartition("word").sortWithinPartitions("word").mapInArrow(_encode_words(tokenizer), _ROWS)
        .withColumn("texts", F.lit(None).cast(f"array<{id_type}>"))
    )
    placed = named.mapInArrow(_block_places(to_arrow_type(named.schema["_id"].dataType)), f"{_ROWS}, texts array<{id_type}>")
    # a block's words come before its texts
    return (
        listed.unionByName(placed).repartition("block").sortWithinPartitions("block", "kind")
        .mapInArrow(_assemble, f"_id {id_type}, ids array<int>, decoded string")
        .select(F.col("_id").alias(id_col), "ids", "decoded")
    )


def decode(coded: DataFrame, tokenizer: str, key: str = "doc_id") -> DataFrame:
    """(key, decoded) of rows (key, ids): ids joined to their pieces, and pieces joined in order.

    ``key`` tells the rows apart. The pieces are the vocabulary, which is of fixed size, so they
    are broadcast. Bytes that are no UTF-8 stay as they are. Null ids give null.
    """
    table = coded.sparkSession.createDataFrame(pd.DataFrame(pieces(tokenizer), columns=["piece_id", "piece"]), "piece_id int, piece binary")
    each = coded.select(key, F.posexplode("ids").alias("at", "piece_id")).join(F.broadcast(table), "piece_id")
    found = F.array_sort(F.collect_list(F.struct("at", "piece")))
    decoded = each.groupBy(key).agg(found.alias("found")).select(
        key, F.aggregate("found.piece", F.lit(b""), lambda done, piece: F.concat(done, piece)).cast("string").alias("decoded")
    )
    return coded.select(key, "ids").join(decoded, key, "left").select(key, F.when(F.size("ids") == 0, "").otherwise(F.col("decoded")).alias("decoded"))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts' ids and decoded texts from the words and the texts of each block."""
    parts: list[bytes] = []
    sizes: list[int] = []
    for batch in batches:
        for row in range(len(batch)):
            kind, size, raw = (batch[x][row].as_py() for x in ("kind", "size", "raw"))
            body = pa.decompress(batch["packed"][row].as_buffer(), raw, codec="zstd", asbytes=True)
            if kind == 0:
                parts.append(body)
                sizes.append(size)
                continue
            if sum(sizes) != size:
                raise ValueError("the two passes over the texts cut different blocks; store the input table first")
            texts = batch["texts"][row].values
            ids, decoded = _word_lists(parts, sizes)
            counts, end = _read_planes(body, 0, len(texts))
            places, _ = _read_planes(body, end, (len(body) - end) // 4)
            first = np.concatenate(([0], np.cumsum(counts.astype(np.int64))))
            for a in range(0, len(counts), 1000):
                b = min(len(counts), a + 1000)
                at, cuts = pa.array(places[first[a] : first[b]]), first[a : b + 1] - first[a]
                yield pa.RecordBatch.from_arrays(
                    [texts.slice(a, b - a), _joined(ids, at, cuts, pa.int32()), _joined(decoded, at, cuts, None, pa.string())], ["_id", "ids", "decoded"]
                )
            parts, sizes = [], []
            del ids, decoded
            pa.default_memory_pool().release_unused()


def _word_lists(parts: list[bytes], sizes: list[int]) -> tuple[pa.Array, pa.Array]:
    """The ids and the decoded bytes of a block's words, by their places."""
    all_places, all_ids, all_text = [], [], []
    for raw, n in zip(parts, sizes):
        places, at = _read_planes(raw, 0, n)
        n_ids, at = _read_planes(raw, at, n)
        n_bytes, at = _read_planes(raw, at, n)
        ids, at = _read_planes(raw, at, int(n_ids.sum()))
        all_places.append(np.cumsum(places))
        all_ids.append(pa.ListArray.from_arrays(_ends(n_ids), pa.array(ids.astype(np.int32))))
        all_text.append(pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(_ends(n_bytes)), pa.py_buffer(raw[at:])]))
    if not parts:
        return pa.array([], pa.list_(pa.int32())), pa.array([], pa.binary())
    order = pa.array(np.argsort(np.concatenate(all_places)))
    return pa.concat_arrays(all_ids).take(order), pa.concat_arrays(all_text).take(order)


def _ends(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths.astype(np.int64)))).astype(np.int32)


def _joined(column: pa.Array, at: pa.Array, cuts: np.ndarray, kind: pa.DataType | None, out: pa.DataType = pa.binary()) -> pa.Array:
    """The values of ``column`` at ``at``, joined between ``cuts``: lists, or bytes as texts."""
    taken = column.take(at)
    ends = np.concatenate(([0], np.cumsum(_lengths(taken, kind))))[cuts].astype(np.int32)
    if kind is not None:
        return pa.ListArray.from_arrays(pa.array(ends), taken.flatten())
    body = taken.buffers()[2] if len(taken) else None
    return pa.Array.from_buffers(out, len(ends) - 1, [None, pa.py_buffer(ends), body or pa.py_buffer(b"")])


def _lengths(taken: pa.Array, kind: pa.DataType | None) -> np.ndarray:
    lengths = pc.binary_length(taken) if kind is None else pc.list_value_length(taken)
    return lengths.to_numpy(zero_copy_only=False).astype(np.int64)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256)."""
    return encoded.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def default_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
