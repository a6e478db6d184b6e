"""Fill-in-middle transformation: cut a text at two token ends and move the middle to the end.

A token is a run of other characters with the blanks (space, 0x09 to 0x0D) before it; blanks at the end of a text are a token of
their own. The ends of a text's tokens are kept as a set of byte offsets in the manner of Roaring sets: offsets are grouped by their
upper bits into ranges of 65,536, and each range lies in the smallest of three containers, a sorted array, a bitmap, or runs. The numbers of
members before each container are kept beside them, so the end of the k-th token is found by a search over containers and a
select within one. A text is read range by range, so beside the text itself a task holds at most an eighth of its size.

Four numbers are drawn for each document: the first four groups of eight digits of the hex sha256 of ``seed:doc_id`` (a null
doc_id is an empty one). The first and second, modulo n + 1, are the numbers of tokens before the two cuts, the smaller one
first. The third (modulo 100) leaves a text as it is (form ``plain``) from ``rate`` on; the fourth chooses ``spm`` below
``spm_rate``, else ``psm``. Empty texts (null ones too) and texts that hold a mark are always plain, so reading back is exact.

Every row gives a row: equal doc_ids get equal draws, equal rows equal results. Columns other than doc_id and text are not read. No rows
give no rows. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressroom.llm.words import pieces, text_bytes

#: The marks, and the blanks.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
BLANKS = (0x20, 9, 10, 11, 12, 13)

RANGE = 1 << 16
_BLANK = np.isin(np.arange(256), BLANKS)
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class ArrayContainer:
    """Members one by one, two bytes each."""

    def __init__(self, members: np.ndarray) -> None:
        self.members = members.astype(np.uint16)
        self.bytes = self.members.nbytes

    def select(self, k: int) -> int:
        return int(self.members[k])


class BitmapContainer:
    """A bit for every offset of the range."""

    def __init__(self, members: np.ndarray) -> None:
        flags = np.zeros(RANGE, bool)
        flags[members] = True
        self.bits = np.packbits(flags, bitorder="little")
        self.bytes = self.bits.nbytes

    def select(self, k: int) -> int:
        upto = np.cumsum(_ONES[self.bits], dtype=np.int64)
        byte = int(np.searchsorted(upto, k, "right"))
        rest = k - (int(upto[byte - 1]) if byte else 0)
        return byte * 8 + int(np.flatnonzero(np.unpackbits(self.bits[byte : byte + 1], bitorder="little"))[rest])


class RunContainer:
    """Runs of neighbours: the first of each, and how many members stand before it."""

    def __init__(self, members: np.ndarray, heads: np.ndarray) -> None:
        self.first = members[heads].astype(np.uint16)
        self.before = heads.astype(np.uint16)
        self.bytes = self.first.nbytes + self.before.nbytes

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


def container(members: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container for ascending members of a range."""
    heads = np.flatnonzero(np.diff(members, prepend=-2) != 1)
    sizes = (2 * len(members), RANGE // 8, 4 * len(heads))
    smallest = sizes.index(min(sizes))
    return RunContainer(members, heads) if smallest == 2 else BitmapContainer(members) if smallest else ArrayContainer(members)


class BoundarySet:
    """Ascending offsets, added range by range."""

    def __init__(self) -> None:
        self.keys: list[int] = []
        self.containers: list = []
        self.upto: list[int] = [0]

    def add(self, key: int, members: np.ndarray) -> None:
        """Members of the range that starts at ``key * RANGE``, as ascending offsets in it; keys have to ascend."""
        if len(members):
            self.keys.append(key)
            self.containers.append(container(members))
            self.upto.append(self.upto[-1] + len(members))

    def __len__(self) -> int:
        return self.upto[-1]

    def select(self, k: int) -> int:
        """The k-th smallest member, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.upto, k, "right")) - 1
        return self.keys[at] * RANGE + self.containers[at].select(k - self.upto[at])


def token_ends(data: np.ndarray) -> BoundarySet:
    """Offsets of the last bytes of a text's tokens; the text is UTF-8 bytes."""
    ends = BoundarySet()
    size = len(data)
    for key, start in enumerate(range(0, size, RANGE)):
        stop = min(start + RANGE, size)
        blank = _BLANK[data[start : min(stop + 1, size)]]
        after = np.append(blank[1:], True) if stop == size else blank[1:]
        here = ~blank[: stop - start] & after
        if stop == size:
            here[-1] = True  # a last run of blanks is a token too
        ends.add(key, np.flatnonzero(here))
    return ends


def cut(data: np.ndarray, ends: BoundarySet, first: int, second: int) -> tuple[int, int]:
    """Byte offsets after ``first`` and after ``second`` tokens."""
    return tuple(ends.select(n - 1) + 1 if n else 0 for n in (first, second))


def _characters(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def draws(seed: int, doc_id: Column) -> list[Column]:
    """Four numbers below 2^32."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars and middle_chars (code points; null if plain) and output of every row."""
    h1, h2, h3, h4 = draws(seed, F.col("doc_id"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = F.when((text == "") | marked | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    rows = docs.select("doc_id", text.alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        for batch in batches:
            for piece in pieces(batch, "text"):
                data, at = text_bytes(piece.column("text"))
                counts, prefixes, middles, outputs = [], [], [], []
                forms, firsts, seconds = (piece.column(c).to_pylist() for c in ("form", "h1", "h2"))
                for i, form in enumerate(forms):
                    own = data[at[i] : at[i + 1]]
                    ends = token_ends(own)
                    n = len(ends)
                    counts.append(n)
                    if form == "plain":
                        prefixes.append(None)
                        middles.append(None)
                        outputs.append(own.tobytes())
                        continue
                    low, high = cut(own, ends, *sorted((firsts[i] % (n + 1), seconds[i] % (n + 1))))
                    prefixes.append(_characters(own[:low]))
                    middles.append(_characters(own[low:high]))
                    parts = {PREFIX: own[:low], SUFFIX: own[high:], MIDDLE: own[low:high]}
                    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
                    outputs.append(b"".join(mark.encode() + parts[mark].tobytes() for mark in order))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"), pa.array(counts, pa.int64()), piece.column("form"), pa.array(prefixes, pa.int64()),
                        pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string()),
                    ],
                    names,
                )

    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from."""

    def between(text: Column, mark: str) -> tuple[Column, Column]:
        head = F.substring_index(text, mark, 1)
        return head, F.substr(text, F.length(head) + len(mark) + 1)

    body = F.substr(output, F.lit(len(PREFIX) + 1))
    first, rest = between(body, SUFFIX)
    second, middle = between(rest, MIDDLE)
    psm = F.concat(first, middle, second)
    first, rest = between(body, PREFIX)
    second, middle = between(rest, MIDDLE)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(second, middle, first)).otherwise(output)
