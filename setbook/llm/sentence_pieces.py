"""SentencePiece encoding and decoding by a Viterbi search with shared prefixes.

A text is marked (a mark before it and for every blank) and cut before its
runs of marks; no piece crosses such a cut.  Of each batch, the distinct
marked words that are not yet known are sorted, which is the depth-first
order of their trie; going through them, the best score and the last piece
of every prefix stay on a stack, so that each trie node is searched once.

The search runs over all pieces that end at a node.  For a model of merges
(BPE) a path may only join two pieces that merging keeps apart, that is,
whose joined text the merges split into just these two; a segmentation is
the merges' own exactly if all its neighbours are such pairs.  The result
therefore equals the library's.  For a unigram model every pair may meet
and the highest sum of scores wins.  Characters that no piece holds are
encoded as byte pieces.  One exception: with merges, a word that holds two
or more blanks in a row is not searched but encoded by the merges themselves
(a heap of pairs), as pieces of blanks have equal scores.  Bounded tables per worker keep frequent words and
pairs.

Decoding joins the pieces' bytes, turns marks into blanks and takes the
mark before the text away; it returns the exact text, also for texts that
hold the mark's own character, which is encoded as bytes.

Defined results: null and empty texts have no pieces and decode to the
empty text; every row gets a row; other columns are kept as they are.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, documents, give_back, held, unused, whole_text

MARK = "\u2581"
MEMO_WORDS = 280_000             # in each of the two generations of a worker's table
_MEMO_LENGTH = 64                # characters of the longest word that the table keeps
_PAIRS_A_WORD = 3.5              # pairs of pieces kept for each word of a generation
_SCORE = ""                      # key of a trie node's own piece
_NOTHING = -1                    # the piece before the first, and after a character without one


class Pieces:
    """A model's pieces as a trie of reversed pieces, with byte and unknown ids.

    ``merges`` says that the model is one of merges, not a unigram model.
    """

    def __init__(self, path: str, merges: bool = True):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.merges, self.memo_words = merges, MEMO_WORDS
        self.texts = [""] * model.get_piece_size()
        self.rank: dict[str, tuple[float, int]] = {}
        self.apart: dict[int, bool] = {}
        self.older: dict[str, bytes] = {}
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_unknown(i) or model.is_control(i)
                                             or model.is_byte(i) or model.is_unused(i))]
        self.unknown = model.unk_id()
        self.bytes_of = [b""] * n
        self.byte_ids: dict[int, int] = {}
        for i in range(n):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:5], 16)
                self.byte_ids[value] = i
                self.bytes_of[i] = bytes([value])
        self.bytes_of[self.unknown] = " \u2047 ".encode()
        self.trie: dict = {}
        for i in plain:
            piece = model.id_to_piece(i).replace(MARK, " ")      # a blank is the mark in here
            self.bytes_of[i] = piece.encode("utf-8")
            self.texts[i] = piece
            self.rank[piece] = (model.get_score(i), i)
            node = self.trie
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[_SCORE] = (model.get_score(i), i)
        self.unknown_score = min(model.get_score(i) for i in plain) - 10.0
        letters = set().union(*(model.id_to_piece(i) for i in plain))
        self.cut = re.compile("(\n)") if "\n" not in letters else None
        self.memo: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """The marked words of a text: with a blank before it, cut before its runs of blanks."""
        if not text:
            return []
        text = " " + text
        if "  " in text or "\0" in text:
            out = re.findall(" +[^ ]*", text)
            if self.cut is None:
                return out
            return [p for w in out for p in (self.cut.split(w) if "\n" in w else (w,)) if p]
        if self.cut is not None:
            text = text.replace("\n", "\0\n\0")
        return [w for w in text.replace(" ", "\0 ").split("\0") if w]

    def merged(self, word: str) -> list[str]:
        """The word after all merges: the best pair of neighbours first, the leftmost of equals."""
        rank, right = self.rank, list(range(1, len(word) + 1))
        left, part = list(range(-1, len(word) - 1)), list(word)
        heap = [(-rank[a + b][0], i, a + b) for i, (a, b) in enumerate(zip(word, word[1:])) if a + b in rank]
        heapq.heapify(heap)

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(part) and (joined := part[i] + part[j]) in rank:
                heapq.heappush(heap, (-rank[joined][0], i, joined))

        while heap:
            _, i, joined = heapq.heappop(heap)
            j = right[i]
            if not part[i] or j >= len(part) or part[i] + part[j] != joined:
                continue                       # one of the two has merged since
            part[i], part[j], right[i] = joined, "", right[j]
            if right[i] < len(part):
                left[right[i]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in part if p]

    def _kept_apart(self, a: int, b: int) -> bool:
        """Whether merges leave the pieces a and b (a may be none) side by side."""
        key = (a + 1) << 32 | b
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) > _PAIRS_A_WORD * self.memo_words:
                self.apart.clear()
            pair = [self.texts[b]] if a == _NOTHING else [self.texts[a], self.texts[b]]
            known = self.apart[key] = self.merged("".join(pair)) == pair
        return known

    def _ids(self, word: str, back: list) -> bytes:
        out, j = [], len(word)
        while j:
            i, piece = back[j]
            if piece is None:
                raw = word[i:j].encode("utf-8", "surrogatepass")
                out.extend([self.byte_ids.get(b, self.unknown) for b in reversed(raw)]
                           if self.byte_ids else [self.unknown])
            else:
                out.append(piece)
            j = i
        return np.array(out[::-1], "<i4").tobytes()

    def segment(self, words: list[str]) -> dict[str, bytes]:
        """Best pieces of each word; ``words`` sorted and distinct."""
        trie, unknown, merges, apart = self.trie, self.unknown_score, self.merges, self.apart
        score, back, ended, before, out = [0.0], [None], [_NOTHING], "", {}
        for word in words:
            if merges and "  " in word:        # pieces of blanks have equal scores: merge them as they stand
                out[word] = self._ids(word, self._path(word))
                continue
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del score[shared + 1:], back[shared + 1:], ended[shared + 1:]
            for j in range(shared + 1, len(word) + 1):
                node, i, single = trie, j, False
                best, last = None, (j - 1, None)
                while i:
                    node = node.get(word[i - 1])
                    if node is None:
                        break
                    i -= 1
                    own = node.get(_SCORE)
                    if own is not None:
                        single = single or i == j - 1
                        s = score[i] + own[0]
                        if best is None or s >= best:
                            if merges:
                                fits = apart.get((ended[i] + 1) << 32 | own[1])
                                if fits is None:
                                    fits = self._kept_apart(ended[i], own[1])
                                if not fits:
                                    continue
                            best, last = s, (i, own[1])
                if best is None or (not merges and not single and score[j - 1] + unknown > best):
                    best, last = score[j - 1] + unknown, (j - 1, None)
                score.append(best)
                back.append(last)
                ended.append(_NOTHING if last[1] is None else last[1])
            out[word] = self._ids(word, back)
            before = word
        return out

    def _path(self, word: str) -> list:
        back, end = [None] * (len(word) + 1), 0
        for p in self.merged(word):
            back[end + len(p)] = (end, self.rank[p][1] if p in self.rank else None)
            end += len(p)
        return back

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Piece ids of each text."""
        cut = [self.words(t) for t in texts]
        if len(self.memo) > self.memo_words:
            self.memo, self.older = {}, self.memo          # what is still in use comes back from there
        memo, older = self.memo, self.older
        new = set().union(*cut).difference(memo)
        memo.update([(w, older[w]) for w in new if w in older])
        memo.update(self.segment(sorted(new.difference(older))))
        out = [np.frombuffer(b"".join(map(memo.__getitem__, w)), "<i4") for w in cut]
        for w in new:
            if len(w) > _MEMO_LENGTH:
                del memo[w]
        return out

    def decode(self, ids) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")[1:]


def _model(path: str) -> Pieces:
    return held("sentence_pieces", path, Pieces)


def _some(values: list, size, most: int = 1 << 22) -> Iterator[list]:
    part, held = [], 0
    for v in values:
        part.append(v)
        held += size(v)
        if held >= most:
            yield part
            part, held = [], 0
    if part:
        yield part


def encoded(text: Column, model_path: str, memo_words: int = MEMO_WORDS) -> Column:
    """Array of piece ids of a text column without nulls; a worker's tables are bounded by ``memo_words``."""
    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _model(model_path)
        model.memo_words = memo_words
        for texts in batches:
            yield pd.Series([i for part in _some(texts.tolist(), len) for i in model.encode(part)], dtype=object)
        give_back()

    return encode(text)


def decoded(ids: Column, model_path: str) -> Column:
    """The text of an array of piece ids."""
    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _model(model_path)
        for rows in batches:
            yield pd.Series([model.decode(r.tolist()) for r in rows], dtype=object)

    return decode(ids)


def encoded_and_decoded(text: Column, model_path: str, memo_words: int = MEMO_WORDS) -> Column:
    """(ids, back): the piece ids of a text column without nulls and the text decoded from them.

    One worker does both; ``decoded`` over ``encoded`` takes two a task, each with the model.
    """
    @F.pandas_udf("ids array<int>, back string")
    def there_and_back(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _model(model_path)
        model.memo_words = memo_words
        for texts in batches:
            ids = [i for part in _some(texts.tolist(), len) for i in model.encode(part)]
            back = [model.decode(i.tolist()) for i in ids]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "back": pd.Series(back, dtype=object)})
        give_back()

    return there_and_back(text)


def round_trip(docs: DataFrame, model_path: str, out: tuple[str, str] = ("piece_ids", "back"),
               memo_words: int = MEMO_WORDS) -> DataFrame:
    """``docs`` and two columns: the piece ids of each whole text, and the text decoded from them."""
    bounded_batches(docs.sparkSession)
    both, = unused(docs, "both")
    return (docs.withColumn(both, encoded_and_decoded(whole_text(), model_path, memo_words))
            .withColumns({out[0]: F.col(both)["ids"], out[1]: F.col(both)["back"]}).drop(both))


def encode_documents(docs: DataFrame, model_path: str, out: str = "piece_ids", memo_words: int = MEMO_WORDS) -> DataFrame:
    """``docs`` and a column ``out`` with the piece ids of each whole text."""
    bounded_batches(docs.sparkSession)
    return docs.withColumn(out, encoded(whole_text(), model_path, memo_words))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: every document encoded and decoded again."""
    path = default_model()
    rows = round_trip(documents(spark, sf_dir), path)
    return rows.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"),
                       F.xxhash64("piece_ids").alias("ids_xxhash64"), (F.col("back") == whole_text()).alias("round_trip"))
