"""Spelling variant grouping by pivotal grams.

Words are counted over all texts; two words are near if one inserted, deleted
or replaced character tells them apart.  Every word has its bigrams ordered by
rarity (in how many words a bigram stands).  Its prefix are the places of its
three rarest bigrams: any three places hold two that do not overlap, and a
dynamic program picks the two disjoint ones with the fewest words, its pivots.
One edit cannot touch both pivots.  So of two near words, the one whose prefix
ends earlier in the rarity order has a pivot that the other one holds
unchanged, and holds within its prefix: pivots are joined with the prefixes.

Position limits: an untouched pivot has the edit either behind it, and then
stands at the same place after the same beginning, or before it, and then
stands at the same place from the end, before the same rest.  The join key is
therefore a hash of the word's part up to (or from) the gram, with the other
word's length, so that a common bigram does not bring all its words together.
What meets is verified by edit distance.

Texts are read once; each task hands on its words with their counts, so a
frequent word crosses the network once a task.  The bigram counts have a
proven bound (the square of the 90 letters), and go to the driver; nothing
else does.

Defined cases: a null or empty text has no words; a null doc_id is written as
nothing in front of the colon; every repeated row counts; a very long run is
one word; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents_of, materialize, small_batches

EDITS = 1
GRAM = 2
PREFIX = GRAM * EDITS + 1
MIN_LENGTH = 6
MIN_COUNT = 5
FORM_FACTOR = 5
LOST_OF = 199
# A word of letters A-Z and U+00C0 to U+00FF in UTF-8, after lower-casing A-Z.
RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
# Words a task holds before it hands them on, and texts beyond which words are not listed at once.
HELD_WORDS = 1 << 18
LIST_BYTES = 1 << 22

Gram = tuple[int, str]


def noisy(run: bytes, prefix_crc: int) -> bytes:
    """The run, without one character where the row's draw says so."""
    draw = zlib.crc32(run, prefix_crc)
    if draw % LOST_OF:
        return run
    text = run.decode()
    at = draw % len(text)
    return (text[:at] + text[at + 1:]).encode()


def words_of(doc_id: int | None, text: bytes) -> Iterator[tuple[bytes, int]]:
    """(word, occurrences) of one text."""
    text = text.lower()  # of bytes: A-Z only
    crc = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    runs = RUN.findall(text) if len(text) <= LIST_BYTES else (m.group() for m in RUN.finditer(text))
    for run, n in Counter(runs).items():
        yield noisy(run, crc), n


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of all texts that are long and frequent enough."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def handed_on() -> pa.RecordBatch:
            # a word of fewer bytes has fewer characters
            keep = [(w, n) for w, n in held.items() if len(w) >= min_length]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in keep], pa.binary()).cast(pa.string()),
                                               pa.array([n for _, n in keep], pa.int64())], names=["word", "n"])
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for word, n in words_of(doc_id, text):
                    held[word] += n
                if len(held) >= HELD_WORDS:
                    yield handed_on()
        yield handed_on()
    small_batches(docs.sparkSession)
    texts = documents_of(docs).withColumn("text", F.col("text").cast("binary"))
    return (texts.mapInArrow(count, "word string, n long").where(F.char_length("word") >= min_length)
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def gram_counts(words: DataFrame) -> dict[str, int]:
    """In how many words each bigram stands: at most the square of the letters' number."""
    places = F.sequence(F.lit(1), F.char_length("word") - (GRAM - 1))
    grams = F.array_distinct(F.transform(places, lambda p: F.substring(F.col("word"), p, F.lit(GRAM))))
    return dict(words.select(F.explode(grams).alias("gram")).groupBy("gram").count().collect())


def prefix(word: str, counts: dict[str, int]) -> tuple[list[tuple[Gram, int]], Gram]:
    """((rarity, bigram), place) of the word's rarest bigrams, and the last one's
    rank; all places of the last bigram count as one, so more than PREFIX can come back."""
    grams = sorted(((counts.get(g := word[i:i + GRAM], 0), g), i) for i in range(len(word) - GRAM + 1))
    last = grams[PREFIX - 1][0]
    return [g for g in grams if g[0] <= last], last


def pivots(places: list[tuple[Gram, int]], wanted: int = EDITS + 1) -> list[tuple[Gram, int]]:
    """The ``wanted`` disjoint places with the least sum of rarity, by dynamic programming."""
    places = sorted(places, key=lambda g: g[1])
    starts = [at for _, at in places]
    free = [bisect_right(starts, at - GRAM) for at in starts]  # how many places end before this one
    # best[k][i]: least weight of k disjoint grams among the first i, and how it comes about
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] * (len(places) + 1)]
    for k in range(1, wanted + 1):
        row: list[tuple[int, tuple[int, ...]] | None] = [None]
        for i, ((weight, _), _) in enumerate(places):
            fewer = best[k - 1][free[i]]
            take = None if fewer is None else (fewer[0] + weight, (*fewer[1], i))
            row.append(min([x for x in (row[-1], take) if x is not None], default=None))
        best.append(row)
    return [places[i] for i in best[wanted][-1][1]]


def running(chars: Iterable[str]) -> list[int]:
    """Hash of every beginning of ``chars``."""
    return list(accumulate(chars, lambda h, c: zlib.crc32(c.encode(), h), initial=0))


def parts(word: str, at: int, ahead: list[int], back: list[int]) -> tuple[int, int]:
    """The word up to the gram at ``at`` and from it on, each as side, length and
    hash in one number: words of any length have keys of one size."""
    left, right = at + GRAM, len(word) - at
    return left << 32 | ahead[left], 1 << 62 | right << 32 | back[right]


def keys(words: DataFrame, counts: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """Index rows of prefixes and probe rows of pivots: (word, part, length, last)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for word in batch.column("word").to_pylist():
                held, (rarity, gram) = prefix(word, counts)
                ahead, back = running(word), running(reversed(word))
                for probe, places in ((False, held), (True, pivots(held))):
                    for _, at in places:
                        out += [(word, probe, part, len(word), rarity, gram) for part in parts(word, at, ahead, back)]
            columns = list(zip(*out, strict=True)) or [()] * 6
            types = (pa.string(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=["word", "probe", "part", "length", "rarity", "gram"])
    small_batches(words.sparkSession)
    rows = materialize(words.select("word").mapInArrow(
        run, "word string, probe boolean, part long, length int, rarity long, gram string"))
    last = F.struct("rarity", "gram").alias("last")
    return (rows.where("NOT probe").select("word", "part", "length", last),
            rows.where("probe").select("word", "part", "length", last))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b), both ways, of all words that one edit tells apart."""
    index, probe = keys(words, gram_counts(words))
    lengths = F.explode(F.array(*[F.col("length") + d for d in range(-EDITS, EDITS + 1)]))
    probe = probe.select(F.col("word").alias("a"), F.col("part").alias("__part"), F.col("last").alias("__last"),
                         lengths.alias("__length"))
    # the word whose prefix ends earlier asks
    met = index.join(probe, (F.col("part") == F.col("__part")) & (F.col("length") == F.col("__length"))
                     & (F.col("last") >= F.col("__last")) & (F.col("word") != F.col("a"))
                     & (F.levenshtein("word", "a", EDITS) == 1))
    found = met.select("a", F.col("word").alias("b"))
    return found.union(found.select(F.col("b"), F.col("a"))).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms(word, form)``: the end of each chain, by doubling its steps."""
    done = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = done.select(F.col("word").alias("__word"), F.col("root").alias("__root"))
        moved = materialize(done.join(ahead, F.col("root") == F.col("__word"), "left")
                            .select("word", F.coalesce("__root", "root").alias("root"),
                                    F.col("__root").isNotNull().alias("moved")))
        done = moved.drop("moved")
        if not moved.where("moved").limit(1).count():
            return done


def _best(n: Column, word: Column) -> Column:
    return F.min(F.struct((-n).alias("minus_n"), word.alias("word")))


def variants(docs: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``."""
    words = materialize(word_counts(docs))
    pairs = near_pairs(words)
    counted = pairs.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    near = (counted.groupBy("a").agg(F.count("*").alias("n_near"), _best(F.col("b_n"), F.col("b")).alias("top"))
            .withColumnRenamed("a", "__near"))
    frequent = -F.col("top.minus_n") >= factor * F.col("n")
    formed = materialize(
        words.join(near, F.col("word") == F.col("__near"), "left")
        .select("word", F.when(frequent, F.col("top.word")).alias("form"), "n",
                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(frequent, -F.col("top.minus_n")).alias("form_n")))
    ends = roots(formed.where("form IS NOT NULL")).withColumnRenamed("word", "__word")
    return (formed.join(ends, F.col("word") == F.col("__word"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
