"""Packing token sequences by bin completion.

Documents are tokenised, closed with an end id and cut only if longer than a sequence. How
well they can be packed depends on the pieces' lengths alone, so the plan is made from a table
of at most ``capacity`` counts, whatever the corpus: around the largest length left, all
undominated fillings of the remaining room are tried, best filled first, each repeated as
often as the counts allow. A branch is given up when the waste it has gathered can't beat the
best plan known; the first such plan comes from best-fit decreasing. The search ends when the
plan meets the lower bound or after ``MAX_NODES`` steps (effort, not data: all pieces are always
placed). Pieces then take their places by their rank among those of equal length.

A null text counts as empty and holds the end id alone. Repeated rows are packed each on its
own. Ties between pieces of equal length are broken by where they are stored.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm.common import bounded_batches, durable

CAPACITY, END_ID = 1024, 2
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Search effort: steps of the search, fillings tried around one piece, pieces in a filling.
MAX_NODES, MAX_FILLINGS, MAX_EXTRA = 4000, 24, 4

#: Runs that the tokenizer never joins: a word with the blank before it, or white space.
RUNS = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: Texts with these are given to the tokenizer whole: libraries differ on whether they are white space, or they are one token.
ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\u180e", "<|endoftext|>")
#: Known runs per worker.
MAX_KNOWN = 300_000

Pattern = tuple[int, ...]


# --- tokens ------------------------------------------------------------------

class RunTokenizer(dict):
    """Ids as little-endian bytes. A byte-level BPE never merges across runs, so known runs are looked up.

    Whole texts go through ``tokenizers``. Unseen runs are short and many, and go through the same
    vocabulary's rank file, which gives the same ids with less work per call.
    """

    def __init__(self, vocabulary: str, ranks: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.encode_run = rank_encoder(ranks) if ranks else lambda run: self.tokenizer.encode(run, add_special_tokens=False).ids

    def __missing__(self, run: str) -> bytes:
        if len(self) >= MAX_KNOWN:
            self.clear()
        ids = self[run] = array("I", self.encode_run(run)).tobytes()
        return ids

    def encode(self, text: str) -> bytes:
        if any(odd in text for odd in ODD):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, RUNS.findall(text)))


def rank_encoder(path: str):
    """The encoding function of a file of merge ranks."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@cache
def tokenizer(vocabulary: str, ranks: str | None = None) -> RunTokenizer:
    return RunTokenizer(vocabulary, ranks)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter than a sequence."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(df: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID,
           vocabulary: str | None = None, ranks: str | None = None, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, local) and, if wanted, ids.

    ``local`` numbers the pieces of equal length within the task ``part``.
    """
    path, end = vocabulary or vocabulary_path(), np.array([end_id], dtype="<u4").tobytes()

    rank_path = ranks or (None if vocabulary else vocabulary_path(RANKS))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seen, encode = TaskContext.get().partitionId(), Counter(), tokenizer(path, rank_path).encode
        for batch in batches:
            rows = []
            for key, value in zip(batch["doc_id"], batch["text"], strict=True):
                ids = memoryview(encode(value or "") + end)
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append((key, k, start, length, zlib.crc32(own), part, seen[length]))
                    if keep_ids:
                        rows[-1] += (np.frombuffer(own, dtype="<u4").astype("int64"),)
                    seen[length] += 1
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": batch["doc_id"].dtype})

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local", *["ids"] * keep_ids]
    kind = df.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, local long" + ", ids array<long>" * keep_ids
    return bounded_batches(df).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, schema)


# --- the plan ----------------------------------------------------------------

def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No plan has fewer sequences: by volume, and by lengths of which no two fit together."""
    best = -(-sum(k * n for k, n in counts.items()) // capacity)
    for small in {0, *(k for k in counts if 2 * k <= capacity)}:
        large = sum(n for k, n in counts.items() if k > capacity - small)
        middle = {k: n for k, n in counts.items() if 2 * k > capacity and k <= capacity - small}
        room = sum((capacity - k) * n for k, n in middle.items())
        rest = sum(k * n for k, n in counts.items() if small <= k and 2 * k <= capacity)
        best = max(best, large + sum(middle.values()) + max(0, -(-(rest - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on counts: equal bins are kept as one pattern and a number."""
    open_bins: dict[int, Counter[Pattern]] = defaultdict(Counter)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r, bins in open_bins.items() if r >= length and bins), default=None)
            if room is None:
                # Fresh bins; each takes as many of this length as fit.
                each = min(capacity // length, left)
                n = left // each
                open_bins[capacity - each * length][(length,) * each] += n
                left -= n * each
                continue
            pattern, n = next(iter(open_bins[room].items()))
            used = min(n, left)
            open_bins[room][pattern] -= used
            open_bins[room] += Counter()
            open_bins[room - length][(*pattern, length)] += used
            left -= used
    return [(p, n) for bins in open_bins.values() for p, n in bins.items() if n]


def dominated(filling: Pattern, slack: int, counts: dict[int, int], lengths: list[int]) -> bool:
    """Whether pieces of the filling could give way to one unused piece that takes at least as much room."""
    used = Counter(filling)
    free = np.array([k for k in lengths if counts[k] > used[k]])
    for size in range(1, len(filling) + 1):
        for some in combinations(filling, size):
            total = sum(some)
            at = np.searchsorted(free, total + (size == 1))
            if at < len(free) and free[at] <= total + slack:
                return True
    return False


def fillings(room: int, counts: dict[int, int]) -> list[Pattern]:
    """Undominated ways to fill ``room``, fullest first, then those of fewer pieces."""
    lengths, out = sorted(k for k, n in counts.items() if n and k <= room), []
    if not lengths:
        return [()]

    def extend(chosen: Pattern, room: int, top: int) -> None:
        if len(out) >= 4 * MAX_FILLINGS:
            return
        options = [k for k in lengths[: int(np.searchsorted(lengths, min(room, top), "right"))] if counts[k] > chosen.count(k)]
        if not options or len(chosen) == MAX_EXTRA:
            if chosen:
                out.append((room, chosen))
            return
        for k in options[: -MAX_FILLINGS - 1 : -1]:
            extend((*chosen, k), room - k, k)

    extend((), room, room)
    out = sorted(set(out), key=lambda x: (x[0], len(x[1]), tuple(-k for k in x[1])))
    best = [chosen for slack, chosen in out if not dominated(chosen, slack, counts, lengths)]
    return (best or [out[0][1]])[:MAX_FILLINGS]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns of lengths and how often each is used; every counted piece is in one."""
    counts = {k: n for k, n in counts.items() if n}
    total, goal = sum(k * n for k, n in counts.items()), lower_bound(counts, capacity) if counts else 0
    best = best_fit(counts, capacity)
    most, nodes = sum(n for _, n in best), 0
    # A stack of (counts left, patterns so far, waste so far); the fullest filling is looked at first.
    stack = [(counts, (), 0)]
    while stack and most > goal and nodes < MAX_NODES:
        left, chosen, waste = stack.pop()
        nodes += 1
        # Sequences are at least what volume and waste together need.
        if -(-(total + waste) // capacity) >= most:
            continue
        if not left:
            best, most = _unfold(chosen), _total(chosen)
            continue
        largest = max(left)
        rest = {**left, largest: left[largest] - 1}
        for filling in reversed(fillings(capacity - largest, rest)):
            pattern = _topped((largest, *filling), left, capacity)
            times = min(left[k] // n for k, n in Counter(pattern).items())
            after = {k: m for k, n in left.items() if (m := n - times * pattern.count(k))}
            stack.append((after, (chosen, (pattern, times)), waste + times * (capacity - sum(pattern))))
    return best


def _topped(pattern: Pattern, counts: dict[int, int], capacity: int) -> Pattern:
    """The pattern with the largest pieces that still fit, for room that short fillings left."""
    used, room = Counter(pattern), capacity - sum(pattern)
    for k in sorted((k for k in counts if k <= room), reverse=True):
        n = min(counts[k] - used[k], room // k)
        pattern, room = pattern + (k,) * n, room - n * k
    return pattern


def _unfold(chosen: tuple) -> list[tuple[Pattern, int]]:
    out = []
    while chosen:
        chosen, own = chosen
        out.append(own)
    return out


def _total(chosen: tuple) -> int:
    return sum(n for _, n in _unfold(chosen))


# --- places ------------------------------------------------------------------

def slots(patterns: list[tuple[Pattern, int]], first_sequence: int) -> dict[int, np.ndarray]:
    """By length: rows (first rank, first sequence, offset); equal patterns serve a stretch of ranks."""
    out, ranks, sequence = defaultdict(list), Counter(), first_sequence
    for pattern, times in patterns:
        offset = 0
        for k in pattern:
            out[k].append((ranks[k], sequence, offset))
            ranks[k] += times
            offset += k
        sequence += times
    return {k: np.array(rows, dtype=np.int64) for k, rows in out.items()}


def place(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``. ``cut_pieces`` must be stored: it is read more than once."""
    per_part = cut_pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # At most one row per length.
    counts = {r["length"]: r["n"] for r in cut_pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    full = counts.pop(capacity, 0)
    table = slots(plan(counts, capacity), full) | {capacity: np.array([(0, 0, 0)], dtype=np.int64)}
    ranked = cut_pieces.join(first, ["length", "part"]).withColumn("rank", F.col("first") + F.col("local"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, offsets = np.zeros(len(batch), dtype=np.int64), np.zeros(len(batch), dtype=np.int64)
            lengths, ranks = batch["length"].to_numpy(), batch["rank"].to_numpy()
            for k in np.unique(lengths):
                at, own = np.flatnonzero(lengths == k), table[int(k)]
                row = own[np.searchsorted(own[:, 0], ranks[at], "right") - 1]
                ids[at], offsets[at] = row[:, 1] + ranks[at] - row[:, 0], row[:, 2]
            yield batch.assign(sequence_id=ids, offset=offsets)

    names = [*cut_pieces.columns, "rank"]
    kinds = dict(ranked.dtypes)
    out = ranked.select(*names).mapInPandas(run, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", sequence_id long, offset long")
    return out.drop("part", "local", "rank")


def pack(df: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, **options) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32, sequence_id, offset)."""
    return place(durable(pieces(df, doc_id, text, capacity, **options)), capacity)


def assemble(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) from pieces packed with ``keep_ids=True``."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(inside, lambda p: p["ids"])).alias("ids"))
