"""Token counts by merging byte pairs, without making token ids.

A piece of text starts as one symbol for each byte in a doubly linked list. A heap holds the
adjacent pairs that have a merge; the lowest rank is popped, leftmost first, its right symbol leaves the
list and the two new neighbours are pushed. A piece's count is its bytes minus its merges.

Pieces are those of the tokenizer's own split. They repeat, so counts are kept by piece, in a
store of bounded size that lives as long as the Python worker.
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1024

# Words, and half as many pieces, whose counts a worker remembers; it starts anew when they are so many.
MOST_REMEMBERED = 1_000_000

# Fixed value: the split of the byte-level tokenizers.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

# Between words a text can be cut at a space, unless white space comes before it.
WIDE_SPACE = regex.compile(r"\s ")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


class Merges:
    """The merges of a byte-level tokenizer file, and the counts they give."""

    def __init__(self, tokenizer: str):
        described = json.loads(tokenizer)
        vocabulary = described["model"]["vocab"]
        self.symbols = [vocabulary[letter] for letter in byte_letters()]
        self.pairs = {}
        for rank, merge in enumerate(described["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[vocabulary[left] << 32 | vocabulary[right]] = rank, vocabulary[left + right]
        special = sorted((token["content"] for token in described["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pieces: dict[str, int] = {}
        self.words: dict[str, int] = {}

    def merged(self, piece: bytes) -> int:
        """Tokens of one piece."""
        size = len(piece)
        if size < 2:
            return size
        pairs = self.pairs
        symbols = [self.symbols[b] for b in piece]
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [found[0] << 40 | i for i in range(size - 1) if (found := pairs.get(symbols[i] << 32 | symbols[i + 1]))]
        heapify(heap)
        tokens = size
        while heap:
            rank, i = divmod(heappop(heap), 1 << 40)
            j = after[i]
            if symbols[i] < 0 or j >= size:
                continue
            found = pairs.get(symbols[i] << 32 | symbols[j])
            if not found or found[0] != rank:
                continue  # one of the two has been merged since
            symbols[i], symbols[j] = found[1], -1
            tokens -= 1
            after[i] = k = after[j]
            if k < size:
                before[k] = i
                if found := pairs.get(symbols[i] << 32 | symbols[k]):
                    heappush(heap, found[0] << 40 | i)
            k = before[i]
            if k >= 0 and (found := pairs.get(symbols[k] << 32 | symbols[i])):
                heappush(heap, found[0] << 40 | k)
        return tokens

    def split_count(self, text: str) -> int:
        """Tokens of a text by the tokenizer's split."""
        total, pieces = 0, self.pieces
        for piece in SPLIT.findall(text):
            count = pieces.get(piece)
            if count is None:
                if len(pieces) >= MOST_REMEMBERED // 2:
                    pieces.clear()
                count = self.merged(piece.encode())
                if len(piece) < 64:
                    pieces[piece] = count
            total += count
        return total

    def plain_count(self, text: str) -> int:
        """Tokens of a text without special strings.

        Where every space follows a word, the text is cut at its spaces: a word with the space before it is
        split by itself as it is within the text.
        """
        if WIDE_SPACE.search(text):
            return self.split_count(text)
        first, *rest = text.split(" ")
        total, words = self.split_count(first), self.words
        for word in rest:
            count = words.get(word)
            if count is None:
                if len(words) >= MOST_REMEMBERED:
                    words.clear()
                count = self.split_count(" " + word)
                if len(word) < 64:
                    words[word] = count
            total += count
        return total

    def count(self, text: str) -> int:
        """Tokens of a text; a special string in it is one token, as the library takes it by default."""
        if self.special is None:
            return self.plain_count(text)
        parts = self.special.split(text)
        return sum(map(self.plain_count, parts)) + len(parts) - 1


def token_counts(documents: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document: bytes and tokens of its whole text.

    ``tokenizer_path`` is a byte-level tokenizer file (JSON); the driver reads it and sends it to the tasks. A null
    text counts as empty. Ids may be null or repeat: every row is counted by itself, without a shuffle. Other columns
    are not read.
    """
    spark = documents.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast({"tokenizer": file.read()})

    @F.arrow_udf("struct<n_bytes: bigint, n_tokens: bigint>")
    def count(texts: pa.Array) -> pa.Array:
        state = shared.value
        if "merges" not in state:
            state["merges"] = Merges(state["tokenizer"])
        merges, sizes, counts = state["merges"], [], []
        for text in texts:
            text = text.as_py() or ""
            sizes.append(len(text.encode()))
            counts.append(merges.count(text))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], ["n_bytes", "n_tokens"])

    counted = documents.select("doc_id", count(F.col("text")).alias("counted"))
    return counted.select(
        "doc_id", "counted.n_bytes", "counted.n_tokens",
        (F.col("counted.n_tokens") > limit).alias("over_limit"))
