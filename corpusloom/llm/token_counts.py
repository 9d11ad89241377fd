"""Word-piece lengths by a linear longest-match automaton.

The vocabulary is a trie with one more number and one link per node: where no branch fits the next character, the
pieces that greedy longest match would cut from what was read are counted (not built), and the link leads to the node
of what is left. Every character is read once. Words are counted once per task as long as they are remembered.

A piece starts a word if it begins with the marker; a word is the marker and its characters. A word that the
vocabulary cannot cut has one token, the unknown one.

Defined cases: a null or blank text has no words and no tokens. Words are [^\\x20\\x09-\\x0D]+.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from corpusloom.llm import scans, tables

VOCABULARY = "piece_bpe_32k.model"
MARKER = "▁"
_HELD_WORDS = 500_000


class Automaton:
    def __init__(self, pieces: Iterable[str]):
        self.branches: list[dict[str, int]] = [{}]
        whole = [False]
        for piece in pieces:
            node = 0
            for character in piece:
                node = self.branches[node].setdefault(character, len(self.branches))
                if node == len(self.branches):
                    self.branches.append({})
                    whole.append(False)
            whole[node] = bool(piece)
        self.link: list[int] = [-1] * len(whole)  # -1: what was read cannot be cut
        self.popped: list[int] = [0] * len(whole)
        waiting = deque([0])
        while waiting:
            node = waiting.popleft()
            for character, child in self.branches[node].items():
                waiting.append(child)
                if whole[child]:
                    self.link[child], self.popped[child] = 0, 1
                    continue
                at, count = self.link[node], self.popped[node]
                while at >= 0 and character not in self.branches[at]:
                    count += self.popped[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[child], self.popped[child] = self.branches[at][character], count

    def count(self, text: str) -> int:
        """Pieces of ``text`` by greedy longest match, 0 if it cannot be cut."""
        branches, link, popped = self.branches, self.link, self.popped
        node = count = 0
        for character in text:
            while (after := branches[node].get(character)) is None:
                count += popped[node]
                node = link[node]
                if node < 0:
                    return 0
            node = after
        while node:
            count += popped[node]
            node = link[node]
            if node < 0:
                return 0
        return count


def sentence_pieces(path: str) -> list[str]:
    """The pieces of a sentencepiece vocabulary, without control pieces and single bytes."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


_HELD: dict[tuple, tuple[Automaton, dict[bytes, int]]] = {}

COUNTS = T.StructType([T.StructField(name, T.LongType()) for name in ("n_words", "n_tokens", "n_unknown")])


def token_counts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary_path: str | None = None,
    read: Callable[[str], list[str]] = sentence_pieces,
    marker: str = MARKER,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per row: the id, ``keep``, ``n_words``, ``n_tokens``, ``n_unknown``. One scan, no shuffle.

    ``vocabulary_path`` names a file that every executor has; without it the public vocabulary is used.
    """
    if vocabulary_path is None:
        import public_tokenizers

        vocabulary_path = public_tokenizers.path(VOCABULARY)

    def compute(rows: pa.RecordBatch) -> list:
        key = vocabulary_path, marker, getattr(read, "__qualname__", "")
        if key not in _HELD:
            _HELD[key] = Automaton(read(vocabulary_path)), {}
        automaton, known = _HELD[key]
        texts = [(text or "").encode().split() for text in rows.column("text").to_pylist()]
        distinct = {word for words in texts for word in words}
        if len(known) > _HELD_WORDS:
            known.clear()
        for word in distinct.difference(known):
            known[word] = automaton.count(marker + word.decode())
        counts = [[known[word] for word in words] for words in texts]
        unknown = [own.count(0) for own in counts]
        return [[len(own) for own in counts], [sum(own) + none for own, none in zip(counts, unknown, strict=True)], unknown]

    return scans.with_columns(docs, compute, COUNTS, id_column, text_column, keep)


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(tables.table(spark, folder, "documents", "doc_id", "text"))
