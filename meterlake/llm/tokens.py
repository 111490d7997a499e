"""Token counts with a unigram vocabulary, by one forward pass over a trie of the distinct pre-tokens.

A pre-token is a run of characters between white space, with the vocabulary's word mark before it. Each node of the trie is a prefix
and holds the cheapest cost of cutting it into pieces and the number of pieces of that cut, so a prefix that many pre-tokens share is
scored once; the counts at the ends of pre-tokens are kept. A piece costs 1000 times the logarithm of its rank in the vocabulary file
(Zipf's law; the file holds no probabilities); a character outside the vocabulary costs its UTF-8 bytes as byte pieces. Costs are whole
numbers, and of equal costs the fewer pieces win, so counts do not depend on order. Tries are built in the tasks from their own texts
and dropped when they hold NODES nodes; nothing is shuffled.

Defined cases: null and empty texts have 0 tokens; repeated rows each get their row; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import table

NODES = 1_000_000
#: Longer pre-tokens are scored on their own and not kept.
LONGEST_KEPT = 128
MARK = "▁"


def piece_costs(vocabulary: str) -> tuple[dict[str, int], int]:
    """Cost of each piece, and of one byte of an unknown character."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    costs, byte = {}, 0
    for i in range(model.get_piece_size()):
        cost = round(1000 * math.log(i + 2))
        if model.is_byte(i):
            byte = max(byte, cost)
        elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
            costs[model.id_to_piece(i)] = cost
    # A byte piece is never cheaper than a piece of the vocabulary.
    return costs, max(byte, *costs.values()) if costs else byte


#: A cut's value: its cost above this many bits, and below them its number of pieces; values add up and compare as pairs.
COUNT_BITS = 32
PIECES = (1 << COUNT_BITS) - 1


class Trie(dict):
    """Pre-token -> number of its pieces. Missing ones are inserted; dropped whole at NODES nodes.

    A node is [value of the best cut of its prefix, children]. Pieces that may end at a character are met by walking back from it
    along a trie of reversed pieces.
    """

    def __init__(self, costs: dict[str, int], byte: int):
        super().__init__()
        self.byte = (byte << COUNT_BITS) + 1
        self.reversed: dict = {}
        for piece, cost in costs.items():
            node = self.reversed
            for character in reversed(piece):
                node = node.setdefault(character, {})
            node[""] = (cost << COUNT_BITS) + 1
        self.drop()

    def drop(self) -> None:
        self.clear()
        self.root: list = [0, None]
        self.nodes = 0

    def forward(self, text: str, end: int, best: list[int]) -> int:
        """Value of text[:end] from those of all shorter prefixes."""
        character = text[end - 1]
        size = 1 if character < "\x80" else len(character.encode("utf-8", "surrogatepass"))
        found = best[end - 1] + size * self.byte
        node, begin = self.reversed.get(character), end - 1
        while node is not None:
            own = node.get("")
            if own is not None and best[begin] + own < found:
                found = best[begin] + own
            if not begin:
                break
            begin -= 1
            node = node.get(text[begin])
        return found

    def __missing__(self, word: str) -> int:
        text = MARK + word
        best = [0]
        if len(text) > LONGEST_KEPT:
            for end in range(1, len(text) + 1):
                best.append(self.forward(text, end, best))
            return best[-1] & PIECES
        if self.nodes >= NODES:
            self.drop()
        node = self.root
        for end, character in enumerate(text, 1):
            if node[1] is None:
                node[1] = {}
            entry = node[1].get(character)
            if entry is None:
                entry = node[1][character] = [self.forward(text, end, best), None]
                self.nodes += 1
            best.append(entry[0])
            node = entry
        self[word] = count = best[-1] & PIECES
        return count


def count_tokens(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_pretokens and n_tokens of every document."""
    rows = docs.select(F.col(key), F.col(text).cast("string"))
    schema = rows.select(key, F.lit(0).cast("long").alias("n_pretokens"), F.lit(0).cast("long").alias("n_tokens")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(*piece_costs(vocabulary))
        for batch in batches:
            words, tokens = [], []
            for value in batch.column(1):
                own = (value.as_py() or "").split()
                words.append(len(own))
                tokens.append(sum([trie[w] for w in own]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=[key, "n_pretokens", "n_tokens"]
            )

    return rows.mapInArrow(run, schema)


def op1_token_counts(spark, folder: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
