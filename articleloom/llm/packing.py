"""Best-fit packing of documents into sequences of bounded length.

Documents become pieces of at most ``capacity`` tokens. Lengths are whole numbers up to the capacity, so all
pieces of one length are a run, and so are all sequences with one gap left: at most ``capacity`` runs of each, whatever
the size of the corpus.

1. Pieces are range-sorted by length over the cluster and numbered; a run is an interval of numbers.
2. In supersteps from the longest length down, a run of pieces sweeps the runs of gaps from its successor on, that is the
   smallest gap that holds the length. Pieces that want the same gap are dealt out by rank: the r-th piece of the
   run takes the r-th sequence with that gap. The gaps are updated, and the run goes on until it is used up; pieces
   that fit no gap open sequences. One superstep moves whole runs, so its work is bounded by the capacity.
3. Each step is an interval of piece numbers and one of sequence numbers. Tasks look up their pieces in
   that table, whose size is bounded by the capacity as well.

The result is that of best-fit decreasing over all pieces.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from articleloom.llm.sharding import numbered_rows
from articleloom.sources.scratch import stored

CAPACITY = 4096
END = 1

# Words whose ids a worker remembers, and the characters it cuts at once.
MOST_REMEMBERED = 1_000_000
AT_ONCE = 2_000_000

STOPS = ".,!?;:"

PIECE = "struct<piece: int, start: bigint, length: bigint, ids_crc32: bigint, ids: binary>"


class WordIds:
    """Token ids of texts, as bytes of little-endian unsigned 32-bit numbers, by way of the words' ids.

    For tokenizers that drop white space, never look across it, lower the case and split letters from stops, the ids
    of a text are those of its words, and the ids of a word those of its letters and of the stops at its end.
    """

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def check(self) -> None:
        """Refuse a tokenizer whose ids are not those of the words, by a text with all that words are parted by."""
        probe = "Some Words,with  stops.And\tTABS;\nlines: 12 times? Yes! \r\n École"
        flat, _ = self.of([probe])
        if flat.tolist() != self.tokenizer.encode(probe, add_special_tokens=False).ids:
            raise ValueError("the tokenizer keeps white space or looks beyond words: their ids are not those of the text")

    @staticmethod
    def _parts(word: str) -> tuple[str, ...]:
        letters = word.rstrip(STOPS)
        # The library lowers a final sigma like any other.
        if letters.isalpha() and "\u03a3" not in letters:
            return letters.lower(), word[len(letters):]
        return (word,)

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin; a last entry is where they end.

        Arrow splits the texts and tells distinct words apart; only these are looked up, and the ids are gathered by their places.
        """
        whole = pa.array(texts, pa.large_string())
        for space in "\n\t\r":
            whole = pc.replace_substring(whole, space, " ")
        split = pc.split_pattern(whole, " ")
        coded = split.flatten().dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        words, parts = self.words, self.parts
        if len(words) > MOST_REMEMBERED:
            words.clear()
        if len(parts) > MOST_REMEMBERED:
            parts.clear()
        new = {word: self._parts(word) for word in distinct if word not in words}
        # Asked one by one: a difference with the keys of a dictionary goes through all of them.
        unseen = list({part for found in new.values() for part in found if part not in parts})
        for part, encoded in zip(unseen, self.tokenizer.encode_batch_fast(unseen, add_special_tokens=False), strict=True):
            parts[part] = array("I", encoded.ids).tobytes()
        for word, found in new.items():
            words[word] = b"".join(map(parts.__getitem__, found))
        held = [words[word] for word in distinct]
        for seen, known in ((new, words), (unseen, parts)):
            for word in seen:
                if len(word) > 64:
                    del known[word]
        ids = np.frombuffer(b"".join(held), np.uint32)
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // 4
        places = coded.indices.to_numpy()
        taken = sizes[places]
        ends = np.concatenate([[0], np.cumsum(taken)])
        starts = (np.cumsum(sizes) - sizes)[places]
        flat = ids[np.repeat(starts - ends[:-1], taken) + np.arange(ends[-1])]
        return flat, ends[split.offsets.to_numpy()]


def document_pieces(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                    keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every document, and ``ids`` if they are kept.

    A document is the ids of its text, then the end id; only documents longer than the capacity are cut.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = file.read()
    WordIds(tokenizer).check()
    shared = documents.sparkSession.sparkContext.broadcast({"tokenizer": tokenizer})
    end = array("I", [END]).tobytes()

    @F.arrow_udf(f"array<{PIECE}>")
    def cut(texts: pa.Array) -> pa.Array:
        state = shared.value
        if "words" not in state:
            state["words"] = WordIds(state["tokenizer"])
        numbers, lengths, sums, kept, offsets, group, size = [], [], [], [], [0], [], 0

        def flush() -> None:
            flat, starts = state["words"].of(group)
            for a, b in zip(starts.tolist(), starts[1:].tolist(), strict=False):
                ids = flat[a:b].tobytes() + end
                for at in range(0, len(ids), 4 * capacity):
                    piece = ids[at:at + 4 * capacity]
                    numbers.append(at // (4 * capacity))
                    lengths.append(len(piece) // 4)
                    sums.append(zlib.crc32(piece))
                    kept.append(piece if keep_ids else None)
                offsets.append(len(numbers))
            group.clear()

        for text in texts:
            group.append(text.as_py() or "")
            size += len(group[-1])
            if size > AT_ONCE:
                flush()
                size = 0
        flush()
        pieces = pa.StructArray.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(np.array(numbers, np.int64) * capacity), pa.array(lengths, pa.int64()),
             pa.array(sums, pa.int64()), pa.array(kept, pa.binary())], ["piece", "start", "length", "ids_crc32", "ids"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pieces)

    pieces = documents.select("doc_id", F.explode(cut(F.col("text"))).alias("p")).select("doc_id", "p.*")
    return pieces if keep_ids else pieces.drop("ids")


def best_fit_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """Steps of the supersteps over runs: (length, first rank in the run, first sequence, offset), longest length first.

    A step places the pieces from its first rank up to the next step's into as many sequences in a row.
    """
    runs: dict[int, list[tuple[int, int]]] = {}
    gaps: list[int] = []
    steps, opened = [], 0

    def add(gap: int, first: int, last: int) -> None:
        if gap:
            if gap not in runs:
                runs[gap] = []
                insort(gaps, gap)
            runs[gap].append((first, last))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            successor = bisect_left(gaps, length)
            if successor == len(gaps):
                needed = -(-left // (capacity // length))
                add(capacity, opened, opened + needed)
                opened += needed
                continue
            gap = gaps[successor]
            first, last = runs[gap].pop()
            taken = min(left, last - first)
            if first + taken < last:
                runs[gap].append((first + taken, last))
            elif not runs[gap]:
                del runs[gap]
                gaps.pop(successor)
            steps.append((length, rank, first, capacity - gap))
            add(gap - length, first, first + taken)
            rank, left = rank + taken, left - taken
    return steps


def best_fit(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    A null or empty text is a document of the end id alone. Repeated rows are documents of their own, null and
    repeated ids are kept as they are; an empty table has no pieces. Other columns are not read.
    """
    pieces = stored(document_pieces(documents, tokenizer_path, capacity, keep_ids), "pieces")
    # Equal rows are told apart by their place, so that no run lands in one task.
    order = ["length", "doc_id", "piece", "ids_crc32", "place"]
    spark = documents.sparkSession
    ranged = (
        pieces.withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
        .sortWithinPartitions(*order).drop("place"))
    ranged = stored(ranged, "ranged_pieces")
    counts = {row["length"]: row["count"] for row in ranged.groupBy("length").count().collect()}
    starts, first = {}, 0
    for length in sorted(counts):
        starts[length] = first
        first += counts[length]
    steps = sorted((starts[length] + rank, sequence, offset)
                   for length, rank, sequence, offset in best_fit_runs(counts, capacity))
    numbers, _ = numbered_rows(ranged, *pieces.columns)
    if not steps:
        return numbers.drop("row_number").select(
            "*", F.lit(None).cast("long").alias("sequence_id"), F.lit(None).cast("long").alias("offset"))
    shared = spark.sparkContext.broadcast(np.array(steps, np.int64).T)

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def place(rows: pa.Array) -> pa.Array:
        first_rows, sequences, offsets = shared.value
        rows = rows.to_numpy(zero_copy_only=False)
        step = np.searchsorted(first_rows, rows, side="right") - 1
        return pa.StructArray.from_arrays(
            [pa.array(sequences[step] + rows - first_rows[step]), pa.array(offsets[step])], ["sequence_id", "offset"])

    return numbers.withColumn("placed", place(F.col("row_number"))).select(
        *pieces.columns, "placed.sequence_id", "placed.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids binary`` of pieces packed with their ids; a group is one sequence, so it is bounded."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda ids, part: F.concat(ids, part["ids"])).alias("ids"))
