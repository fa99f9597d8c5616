"""Fill-in-middle: texts cut at code points that counts of content-defined chunks locate, and put together in another order."""

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tapekeeper.llm.shared import byte_slices, plain, text_of

# Bytes of a chunk: at least, at most, and about how many more than the least on average.
LEAST, MOST, MEAN = 64, 4096, 256

# Bytes of chunks that a task remembers; beyond this it starts anew, which changes no result.
REMEMBERED = 32 << 20

# Bytes hashed at a time.
STEP = 1 << 21

# What stands before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")

# The bytes that go on with a code point.
CONTINUATION = bytes(range(0x80, 0xC0))


def rolling_hash(data: np.ndarray, seed: int = 17) -> np.ndarray:
    """For each byte a hash of the 32 bytes that end there: random words of the bytes, shifted by their age and summed."""
    words = np.random.default_rng(seed).integers(0, 1 << 32, 256, np.uint64).astype(np.uint32)
    sums, age = words[data], 1
    while age < 32:
        older = np.zeros_like(sums)
        older[age:] = sums[:-age] << np.uint32(age)
        sums, age = sums + older, age * 2
    return sums


def break_points(data: np.ndarray) -> np.ndarray:
    """Ends of the places whose hash is zero in its high bits, one in ``MEAN``; hashed piece by piece."""
    found = [np.empty(0, np.int64)]
    for first in range(0, len(data), STEP):
        before = min(first, 31)
        sums = rolling_hash(data[first - before:first + STEP])[before:]
        found.append(np.nonzero(sums >> np.uint32(32 - (MEAN.bit_length() - 1)) == 0)[0] + first + 1)
    return np.concatenate(found)


def chunk_ends(breaks: list[int], start: int, end: int) -> list[int]:
    """Ends of the chunks of the bytes from ``start`` to ``end``: at break points, none shorter than LEAST but the last, none
    longer than MOST. As LEAST exceeds the hash's reach, equal texts have equal chunks whatever stands before them."""
    ends = []
    while start < end:
        at = bisect_left(breaks, start + LEAST)
        start = min(breaks[at] if at < len(breaks) else end, start + MOST, end)
        ends.append(start)
    return ends


class Summary(NamedTuple):
    """What a chunk tells of itself whatever its neighbours: code points that begin in it, whether it holds a sentinel, and
    the bytes at its borders in which a sentinel may begin or end."""

    starts: int
    held: bool
    head: bytes
    tail: bytes


class Summaries(dict):
    """chunk -> Summary. The key is the content itself, so a chunk met again is compared byte by byte, not by its hash."""

    def __init__(self, sentinels: tuple[bytes, ...]):
        super().__init__()
        self.sentinels, self.border, self.size = sentinels, max(map(len, sentinels)) - 1, 0

    def __missing__(self, chunk: bytes) -> Summary:
        if self.size > REMEMBERED:
            self.clear()
            self.size = 0
        self.size += len(chunk) + 256
        self[chunk] = made = Summary(len(chunk.translate(None, CONTINUATION)), self.any_in(chunk),
                                     chunk[:self.border], chunk[-self.border:])
        return made

    def any_in(self, text: bytes) -> bool:
        return any(s in text for s in self.sentinels)


class ChunkedText:
    """A text as chunks and their summaries: its length in code points, whether it holds a sentinel, and where its code points lie."""

    def __init__(self, text: bytes, ends: list[int], known: Summaries):
        self.text, self.ends = text, [0, *ends]
        parts = [known[text[a:b]] for a, b in zip(self.ends, ends)]
        self.before = [0, *accumulate(p.starts for p in parts)]
        self.length = self.before[-1]
        # All chunks but the last are longer than any sentinel, so one across borders lies in a tail and the next head.
        self.held = any(p.held for p in parts) or any(known.any_in(p.tail + q.head) for p, q in zip(parts, parts[1:]))

    def offset(self, points: int) -> int:
        """The byte at which code point number ``points`` begins; only its chunk is looked through."""
        if points == 0 or points >= self.length:
            return 0 if points == 0 else len(self.text)
        at = bisect_right(self.before, points) - 1
        chunk = np.frombuffer(self.text, np.uint8, self.ends[at + 1] - self.ends[at], self.ends[at])
        return self.ends[at] + int(np.nonzero((chunk & 0xC0) != 0x80)[0][points - self.before[at]])


def draws(id_column: Column, seed: int) -> Column:
    """Four unsigned 32-bit numbers: the first groups of eight digits of the SHA-256 of ``seed``, a colon and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def fill_in_middle(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20,
                   sentinels: tuple[str, str, str] = SENTINELS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) per row: n code points, of which prefix and middle end at two drawn ones.

    Forms: ``psm`` is prefix, suffix, middle, ``spm`` suffix, prefix, middle, each after its sentinel;
    ``plain`` is the text itself, for empty texts, texts that hold a sentinel, and a drawn share.
    Draws depend on id and seed only, so rows that share an id share them; a null id counts as the empty string. Null text
    is empty text. Whole texts are cut into content-defined chunks; passages that many texts share are
    counted once per task, and a cut is found by adding up the chunks' counts. Nothing is shuffled.
    """
    marks = tuple(s.encode() for s in sentinels)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Summaries(marks)
        for batch in batches:
            texts, numbers = [t.as_py() for t in batch.column(1)], batch.column(2).to_pylist()
            for first, last in byte_slices(texts, STEP):
                joined = b"".join(texts[first:last])
                breaks = break_points(np.frombuffer(joined, np.uint8)).tolist()
                start, rows = 0, []
                for text, (h1, h2, h3, h4) in zip(texts[first:last], numbers[first:last]):
                    ends = [e - start for e in chunk_ends(breaks, start, start + len(text))]
                    start += len(text)
                    whole = ChunkedText(text, ends, known)
                    n = whole.length
                    if not text or whole.held or h3 % 100 >= 100 - plain_percent:
                        rows.append((n, "plain", None, None, text))
                        continue
                    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                    i, j = whole.offset(a), whole.offset(b)
                    prefix, suffix, middle = marks[0] + text[:i], marks[1] + text[j:], marks[2] + text[i:j]
                    spm = h4 % 100 < spm_percent
                    rows.append((n, "spm" if spm else "psm", a, b - a, suffix + prefix + middle if spm else prefix + suffix + middle))
                n, form, before, middle, output = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(before, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary())],
                    names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(plain(id_column).alias("id"), text_of(text_column).cast("binary").alias("text"),
                       draws(plain(id_column), seed).alias("draws"))
    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(cut, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary")
    return made.withColumn("output", F.col("output").cast("string"))


def restored(form: Column, output: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made from, put together from output and form alone."""
    parts = F.split(output, "|".join(f"\\Q{s}\\E" for s in sentinels))
    return (F.when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
            .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
            .otherwise(output))
