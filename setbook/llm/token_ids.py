"""Token ids of documents, written as Simple-8b shards and read back.

``write_ids`` deals the documents out by ranges of doc_id, encodes each
range in order and writes it as one shard.  A shard is a Parquet file of
chunks; a chunk holds the ids of a run of whole documents:

    shard, chunk   place of the chunk in ascending order
    first          ids of the shard before this chunk
    doc_ids        documents of the chunk, in order
    lengths        ids of each document, end id included
    words          Simple-8b words, 64-bit little-endian
    offsets        word offset of each block of 1,024 ids, 64-bit little-endian
    escapes        raw values of escaped ids, 64-bit little-endian

A chunk is closed once it has ``chunk_ids`` ids, so a task holds one chunk
and one batch of texts, and any chunk can be decoded alone.  Files are
committed by Spark: a lost task is run again and leaves nothing behind.

``read_ids`` decodes the chunks.  What stands before a shard is the sum
over earlier shards, one number a shard.

Texts are cut at single blanks and line ends between other characters,
where the tokenizer's own splitting always cuts too.  The distinct pieces of
many texts are looked up together; their ids are kept in a bounded table per
worker, so that the library encodes a frequent piece once.  Pieces that the
tokenizer's pattern never cuts go to its model without that pattern.

Defined results: a null text counts as empty and has the end id only; a
null doc_id comes first; repeated ids are ordered by text; an empty table
gives no chunk.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import simple8b
from .common import bounded_batches, documents, held, scratch_path, whole_text

END_ID = 2
CHUNKS = ("shard long, chunk long, first long, doc_ids array<long>, lengths array<long>, "
          "words binary, offsets binary, escapes binary")

# pieces in each of the two generations of the table
_MEMO_PIECES = 800_000
# white space other than blank and line end, as Python and the tokenizer's pattern see it
_OTHER_SPACE = re.compile(r"[^\S\n ]")
_TOUCHING = ("  ", "\n\n", " \n", "\n ")
# what the tokenizer's pattern never cuts: a blank and letters (Latin ones here), and marks without the apostrophe
_LETTERS, _MARKS = " ?[A-Za-zªµºÀ-ÖØ-öø-ʯ]+", "[!-&(-/:-@\\[-`{-~]+"
_WORD_AND_MARKS = re.compile(f"({_LETTERS})?({_MARKS})?")
_WORDS_A_CALL = 256
_IS_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
_IS_MARK = np.array([b < 128 and re.fullmatch(_MARKS, chr(b)) is not None for b in range(256)])


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class PieceEncoder:
    """Ids of whole texts, through a bounded table from piece (UTF-8) to ids (as bytes)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.letters = _byte_letters()
        self.line_end = self._line_end()
        self.single = self._single()
        self.whole = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _line_end(self) -> int | None:
        """The id of a line end, if line ends separate words for this tokenizer."""
        one = lambda t: self.tokenizer.encode(t, add_special_tokens=False).ids
        end = one("\n")
        return end[0] if len(end) == 1 and one("a\n b\nc") == one("a") + end + one(" b") + end + one("c") else None

    def _single(self):
        """The tokenizer's model behind a plain cut at line ends, for words that its own pattern never cuts, written
        in the letters of their bytes; None for a tokenizer of another kind."""
        from tokenizers import Tokenizer, pre_tokenizers

        says = json.loads(self.tokenizer.to_str())
        how = says["pre_tokenizer"] or {}
        if (self.line_end is None or says["normalizer"] or how.get("type") != "ByteLevel" or how.get("add_prefix_space")
                or not how.get("use_regex") or any(_WORD_AND_MARKS.fullmatch(t["content"]) for t in says["added_tokens"])):
            return None
        out = Tokenizer(self.tokenizer.model)
        out.pre_tokenizer = pre_tokenizers.Split(self.letters[10], "isolated")
        return out

    def _odd(self, text: str) -> bool:
        """The text may have white space that is not a single blank or line end between other characters, or tokens
        that the tokenizer takes out before it cuts."""
        return any(t in text for t in self.whole) or text[0] in " \n" or text[-1] in " \n" or any(t in text for t in _TOUCHING) or bool(_OTHER_SPACE.search(text))

    def _cuts(self, texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """(all texts, where their pieces begin, where the texts begin and end): cut where a cut never changes the ids."""
        raw = [t.encode("utf-8") for t in texts]
        data = b"".join(raw)
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)])
        chars = np.frombuffer(data, np.uint8)
        line = chars == 10
        begins = line | (chars == 32)
        begins[1:] |= line[:-1]
        if self.single is not None:
            # a letter and the marks behind it are always separate, and repeat more often apart
            letter = _IS_LETTER[chars]
            latin = (chars[:-1] == 0xC3) & (chars[1:] != 0x97) & (chars[1:] != 0xB7)       # À to ÿ but × and ÷
            letter[1:] |= latin
            begins[1:] |= letter[:-1] & _IS_MARK[chars[1:]]
        for t, a, e in zip(texts, bounds.tolist(), bounds[1:].tolist()):
            if t and self._odd(t):
                begins[a:e] = False
                sizes = [len(p.encode("utf-8")) for p in re.split(r"(?<=\S)(?= \S)", t)]
                begins[a + np.cumsum(sizes[:-1], dtype=np.int64)] = True
        begins[bounds[bounds < len(data)]] = True
        return data, np.flatnonzero(begins), bounds

    def _separate(self, tokenizer, texts: list[str]) -> list[bytes]:
        """Ids of the words, one a line, of each text, as bytes."""
        out = []
        for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(e.ids, "<u4")
            cuts = [-1, *np.flatnonzero(ids == self.line_end).tolist(), len(ids)]
            raw = ids.tobytes()
            out.extend([raw[4 * a + 4:4 * b] for a, b in zip(cuts, cuts[1:])])
        return out

    def _learn(self, new: list[str], single: list[str]) -> None:
        """Put the ids of pieces into the table; words without inner white space go many at a time, and those of
        ``single``, which the tokenizer's pattern never cuts, straight to its model."""
        memo = self.memo
        # a line end stands for itself in the texts, and for its byte's letter in those in the letters of bytes
        groups = [single[k:k + _WORDS_A_CALL] for k in range(0, len(single), _WORDS_A_CALL)]
        lines = ["\n".join(g).encode("utf-8").decode("latin-1").translate(self.letters) for g in groups]
        memo.update(zip([p.encode("utf-8") for p in single], self._separate(self.single, lines) if lines else ()))
        # printable: of all white space at most blanks
        words = [p for p in new if p.isprintable() and " " not in p[1:] and p != " "] if self.line_end is not None else []
        lines = ["\n".join(words[k:k + _WORDS_A_CALL]) for k in range(0, len(words), _WORDS_A_CALL)]
        memo.update(zip([p.encode("utf-8") for p in words], self._separate(self.tokenizer, lines) if lines else ()))
        rest = [p for p in new if p.encode("utf-8") not in memo]
        for k in range(0, len(rest), 4096):
            part = rest[k:k + 4096]
            for p, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                memo[p.encode("utf-8")] = np.array(e.ids, "<u4").tobytes()

    def _ids_of(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces, through the table."""
        if len(self.memo) > _MEMO_PIECES:
            self.memo, self.older = {}, self.memo       # what is still in use comes back from there
        memo, older = self.memo, self.older
        found = list(map(memo.get, pieces))
        gaps = [k for k, v in enumerate(found) if v is None]
        if not gaps:
            return found
        new = [pieces[k] for k in gaps]
        memo.update([(p, older[p]) for p in new if p in older])
        parted, single, others = [], set(), []
        for p in new:
            if p in memo:
                continue
            text = p.decode("utf-8")
            m = _WORD_AND_MARKS.fullmatch(text) if self.single is not None else None
            if m is None:
                others.append(text)
                continue
            parts = [x for x in m.groups() if x]
            single.update(parts)
            if len(parts) > 1:
                parted.append((p, [x.encode("utf-8") for x in parts]))
        self._learn(others, [w for w in single if w.encode("utf-8") not in memo])
        memo.update([(p, memo[w] + memo[marks]) for p, (w, marks) in parted])
        for k in gaps:
            found[k] = memo[pieces[k]]
        return found

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers."""
        data, begins, bounds = self._cuts(texts)
        if not len(begins):
            return [np.empty(0, "<u4") for _ in texts]
        # the distinct pieces of all texts together are looked up, and their ids dealt out by piece
        offsets = np.append(begins, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        found = self._ids_of(pieces.dictionary.to_pylist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids, at = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        kinds = pieces.indices.to_numpy()
        n = sizes[kinds]
        ends = np.concatenate([[0], np.cumsum(n)])
        out = ids[np.arange(ends[-1]) + np.repeat(at[kinds] - ends[:-1], n)]
        cuts = ends[np.searchsorted(begins, bounds)].tolist()
        return [out[a:e] for a, e in zip(cuts, cuts[1:])]


def _encoder(path: str) -> PieceEncoder:
    return held("token_ids", path, PieceEncoder)


def _slices(texts: list[str], most: int = 1 << 22) -> Iterator[slice]:
    """Runs of texts of about ``most`` characters."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _shard_writer(path: str, end_id: int, chunk_ids: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        shard, chunk, first = TaskContext.get().partitionId(), 0, 0
        names, runs, held = [], [], 0
        end = np.array([end_id], "<u4")

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(runs)
            words, offsets, escapes = simple8b.encode(ids)
            return pa.RecordBatch.from_pydict({
                "shard": [shard], "chunk": [chunk], "first": [first], "doc_ids": [names],
                "lengths": [[len(r) for r in runs]], "words": [words.astype("<u8").tobytes()],
                "offsets": [offsets.astype("<u8").tobytes()], "escapes": [escapes.astype("<u8").tobytes()],
            }, schema=_chunk_schema())

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for part in _slices(texts):
                for doc, tokens in zip(ids[part], encoder.encode(texts[part])):
                    names.append(doc)
                    runs.append(np.concatenate([tokens, end]))
                    held += len(runs[-1])
                    if held >= chunk_ids:
                        yield closed()
                        chunk, first = chunk + 1, first + held
                        names, runs, held = [], [], 0
        if names:
            yield closed()
    return run


def _chunk_schema() -> pa.Schema:
    return pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("first", pa.int64()),
                      ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                      ("words", pa.binary()), ("offsets", pa.binary()), ("escapes", pa.binary())])


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
              chunk_ids: int = 1 << 14) -> None:
    """Encode every document and write the shards below ``path``, in ascending doc_id order."""
    bounded_batches(docs.sparkSession, 4000)
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    ordered.mapInArrow(_shard_writer(tokenizer_path, end_id, chunk_ids), CHUNKS).write.parquet(path)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document: its place within the shard, its number of ids and their crc32."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = simple8b.decode(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["escapes"], "<u8"))
            ids = ids.astype("<u4")
            lengths = np.array(row["lengths"])
            ends = np.cumsum(lengths)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "shard": pa.array([row["shard"]] * len(lengths), pa.int64()),
                "within": pa.array(row["first"] + ends - lengths),
                "n_tokens": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(ends, lengths)], pa.int64()),
            })


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The written chunks."""
    return spark.read.schema(CHUNKS).parquet(path)


def document_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files alone: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is
    over the ids as little-endian unsigned 32-bit integers.
    """
    bounded_batches(spark)
    shards = (read_ids(spark, path).select("shard", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
                                           .alias("n")).groupBy("shard").agg(F.sum("n").alias("n")))
    # one row a shard: as many as the writing job had tasks
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    found = read_ids(spark, path).mapInArrow(
        _decoded, "doc_id long, shard long, within long, n_tokens long, ids_crc32 long")
    return found.join(shards, "shard").select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def ids_of(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of the named documents (one row for each of its rows), from the written chunks.

    Only chunks that hold one of them are read, and of these only the blocks
    that their ids lie in are decoded, through the blocks' offsets.
    """
    wanted = sorted(set(doc_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = set(wanted)
        for batch in batches:
            for row in batch.to_pylist():
                words, offsets, escapes = (np.frombuffer(row[c], "<u8") for c in ("words", "offsets", "escapes"))
                ends = np.cumsum(row["lengths"])
                found = [(d, int(e) - n, int(e)) for d, n, e in zip(row["doc_ids"], row["lengths"], ends) if d in mine]
                ids = [simple8b.decode_range(words, offsets, escapes, a, e).astype(np.int64) for _, a, e in found]
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([d for d, _, _ in found], pa.int64()),
                                                  "ids": pa.array(ids, pa.list_(pa.int64()))})

    bounded_batches(spark, 8)
    holds = F.arrays_overlap("doc_ids", F.array(*[F.lit(d).cast("long") for d in wanted]).cast("array<long>"))
    return read_ids(spark, path).where(holds).mapInArrow(run, "doc_id long, ids array<long>")


def op4_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: every document encoded, written, read back and digested."""
    import public_tokenizers

    path = scratch_path(spark, "token-ids")
    write_ids(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"))
    return document_index(spark, path)
