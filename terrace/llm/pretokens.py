"""Where the pieces of a text begin, found with arrays instead of a regular expression.

The pieces are those of the pattern that byte-level vocabularies split texts by::

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Every code point has a class, which an array holds. Whether a piece begins at a character
follows from its class and those of the two characters around it, for all characters at once;
the few quotes with which a piece begins are looked at again, as they may begin a contraction.

A machine with states says the same one character after the other: a class is a function from
states to states, and these functions compose associatively, each a number and composing two
a look-up in a table (:func:`scan`). It takes several times as long and serves as the
definition that the tests hold the shorter rules to.
"""

from __future__ import annotations

import itertools
from array import array
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa

CODE_POINTS = 0x110000
#: Code points whose classes are asked for at once; surrogates fill whole parts.
ASKED = 0x800
#: Distinct pieces that a worker remembers, and those it has merged at once.
REMEMBERED, MERGED = 600_000, 4096

#: Classes of code points. END stands after every text.
LETTER, NUMBER, OTHER, BLANK, SPACE, QUOTE, SINGLE, R_OR_V, E, L, END = range(11)
#: The kind of a class; pieces but contractions are of one kind, after a blank at most.
KINDS = np.array([2, 3, 4, 0, 1, 4, 2, 2, 2, 2, 5], np.uint8)
BLANKS, SPACES = 0, 1
#: States: what the characters so far are, since the piece or the white space began.
(
    START, LETTERS, NUMBERS, OTHERS, BLANK_1, BLANK_MORE, SPACE_1, SPACE_MORE, QUOTED, QUOTED_RV,
    QUOTED_L, CLOSED,
) = range(12)
#: A piece begins here; a piece begins at the position before.
HERE, BEFORE = 1, 2

_LETTERS = (LETTER, SINGLE, R_OR_V, E, L)


def _step(state: int, seen: int) -> tuple[int, int]:
    """The next state, and where pieces begin."""
    if seen == END:
        return START, HERE | (BEFORE if state in (QUOTED_RV, QUOTED_L) else 0)
    if state == QUOTED:
        if seen == SINGLE:
            return CLOSED, 0
        if seen in (R_OR_V, L):
            return (QUOTED_RV if seen == R_OR_V else QUOTED_L), 0
        state = OTHERS
    if state in (QUOTED_RV, QUOTED_L):
        if (state, seen) in ((QUOTED_RV, E), (QUOTED_L, L)):
            return CLOSED, 0
        # The quote stood for itself, and a piece of letters began after it.
        after, begins = _step(LETTERS, seen)
        return after, begins | BEFORE
    spaces = state in (BLANK_1, BLANK_MORE, SPACE_1, SPACE_MORE)
    if seen in (BLANK, SPACE):
        if spaces:
            return (BLANK_MORE if seen == BLANK else SPACE_MORE), 0
        return (BLANK_1 if seen == BLANK else SPACE_1), HERE
    # The last of several white spaces is no part of those before it.
    begins = BEFORE if state in (BLANK_MORE, SPACE_MORE) else 0
    joined = state in (BLANK_1, BLANK_MORE)
    kind = LETTERS if seen in _LETTERS else NUMBERS if seen == NUMBER else OTHERS
    if kind == state:
        return state, 0
    if seen == QUOTE and not joined:
        kind = QUOTED
    return kind, begins | (0 if joined else HERE)


_TABLE = [[_step(state, seen) for seen in range(END + 1)] for state in range(CLOSED + 1)]


def _closure() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Functions by number (the identity is 0), the classes' numbers, and the products."""
    own = [tuple(_TABLE[state][seen][0] for state in range(CLOSED + 1)) for seen in range(END + 1)]
    number = {tuple(range(CLOSED + 1)): 0}
    found = list(number)
    for f in found:  # grows while it is read
        for g in own:
            after = tuple(g[x] for x in f)
            if after not in number:
                number[after] = len(found)
                found.append(after)
    functions = np.array(found, np.uint8)
    after = functions[np.arange(len(found))[None, :, None], functions[:, None, :]]
    products = np.array([[number[tuple(f)] for f in row] for row in after.tolist()], np.uint16)
    return functions, np.array([number[g] for g in own], np.uint16), products


FUNCTIONS, OF_CLASS, PRODUCTS = _closure()
#: Products by two numbers in one: the first one shifted, then the second.
_SHIFT = int(len(FUNCTIONS) - 1).bit_length()
_PRODUCT = np.zeros(len(FUNCTIONS) << _SHIFT, np.uint16)
_PRODUCT.reshape(len(FUNCTIONS), -1)[:, : len(FUNCTIONS)] = PRODUCTS


def scan(numbers: np.ndarray) -> np.ndarray:
    """The product of the functions up to each position, that position's included."""
    n = len(numbers)
    if n < 64:
        out = numbers.copy()
        for i in range(1, n):
            out[i] = PRODUCTS[out[i - 1], out[i]]
        return out
    long = int(np.sqrt(n)) + 1
    runs = -(-n // long)
    side = np.zeros(runs * long, np.uint16)  # filled up with the identity
    side[:n] = numbers
    side = np.ascontiguousarray(side.reshape(runs, long).T)
    for i in range(1, long):
        side[i] = _PRODUCT[(side[i - 1] << _SHIFT) | side[i]]
    before = np.concatenate([np.zeros(1, np.uint16), scan(side[-1].copy())[:-1]])
    out = _PRODUCT[(before << _SHIFT)[None, :] | side]
    return np.ascontiguousarray(out.T).ravel()[:n]


def class_table(letter: np.ndarray, number: np.ndarray, space: np.ndarray) -> np.ndarray:
    """The class of every code point, from three masks of code points."""
    table = np.full(CODE_POINTS, OTHER, np.uint8)
    for mask, kind in ((letter, LETTER), (number, NUMBER), (space, SPACE)):
        table[mask] = kind
    fixed = {"'": QUOTE, " ": BLANK, "e": E, "l": L} | dict.fromkeys("rv", R_OR_V)
    for character, kind in (fixed | dict.fromkeys("stmd", SINGLE)).items():
        table[ord(character)] = kind
    return table


def masks(matches: Callable[[str, str], Sequence[str]]) -> list[np.ndarray]:
    """Masks of letters, numbers and white space; ``matches(pattern, text)`` are one-character
    matches as the library that is followed finds them, whatever edition of Unicode it has."""
    found = []
    for pattern in (r"\p{L}", r"\p{N}", r"\s"):
        mask = np.zeros(CODE_POINTS, bool)
        for start in range(0, CODE_POINTS, ASKED):  # a few at a time, as libraries keep much of a text
            if not 0xD800 <= start < 0xE000:  # surrogates are no characters
                some = matches(pattern, "".join(map(chr, range(start, start + ASKED))))
                mask[[ord(c) for c in some]] = True
        found.append(mask)
    return found


def begins(codes: np.ndarray, table: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each character; ``edges`` are where texts begin, and the end."""
    n = len(codes)
    edge = np.zeros(n + 2, bool)
    edge[edges] = True
    kinds = KINDS[table][codes]
    white = kinds <= SPACES
    # White space goes on whatever it is, and a blank is joined to what follows it.
    first = edge[:n].copy()
    first[1:] |= (kinds[1:] != kinds[:-1]) & (kinds[:-1] != BLANKS) & ~(white[1:] & white[:-1])
    # The last of several white spaces before something else is no part of those before it.
    first[1:-1] |= white[:-2] & white[1:-1] & ~(white[2:] | edge[2:n])
    # A quote with which a piece begins, and a contraction after it.
    quotes = np.flatnonzero(codes == ord("'"))
    quotes = quotes[first[quotes]]
    one, two = (table[codes[np.minimum(quotes + i, n - 1)]] for i in (1, 2))
    one[edge[quotes + 1]] = END
    two[edge[quotes + 1] | edge[np.minimum(quotes + 2, n)]] = END
    long = ((one == R_OR_V) & (two == E)) | ((one == L) & (two == L))
    whole = (one == SINGLE) | long
    first[quotes[whole] + 1] = False
    after = (quotes + 2 + long)[whole]
    first[after[after < n]] = True
    return first


def pieces(texts: pa.Array, table: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All pieces of the texts one after another (binary), and how many each text has.

    ``texts`` has no nulls. The pieces are slices of the texts' own bytes, uncopied.
    """
    texts = texts.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2] or pa.py_buffer(b"")
    whole = data[int(ends[0]) : int(ends[-1])]
    codes = np.frombuffer(str(whole, "utf-8").encode("utf-32-le"), np.uint32)
    if len(codes) == len(whole):
        at = np.arange(len(codes) + 1)
        chars = ends - ends[0]
    else:
        wide = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
        at = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(wide, dtype=np.int64, out=at[1:])
        chars = np.searchsorted(at, ends - ends[0])
    first = begins(codes, table, chars)
    starts = np.flatnonzero(first)
    offsets = np.append(at[starts], at[-1])
    counts = np.searchsorted(starts, chars)
    found = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), whole]
    )
    return found, np.diff(counts)


def _slices(values: pa.LargeBinaryArray) -> list[bytes]:
    """The values; cut here, which is several times as fast as one by one."""
    if not len(values):
        return []
    ends = np.frombuffer(values.buffers()[1], np.int64)[: len(values) + 1].tolist()
    data = values.buffers()[2].to_pybytes()
    return [data[a:b] for a, b in itertools.pairwise(ends)]


def packed(ids: list[int], sizes: Iterable[int]) -> list[bytes]:
    """Lists of these sizes, each as 32-bit integers, which is compact."""
    data = array("i", ids).tobytes()
    ends = itertools.accumulate((4 * n for n in sizes), initial=0)
    return [data[a:b] for a, b in itertools.pairwise(ends)]


class PieceIds:
    """Ids of texts, piece by piece. A batch has each distinct piece once, and the ids of a piece
    are made once as long as it is remembered.

    ``merge`` gives the ids of some pieces, and how many each has. What was met lately is
    remembered: when a third of ``remembered`` has come, it takes the place of the third before
    it, of which stays what is met again.
    """

    def __init__(
        self,
        table: np.ndarray,
        merge: Callable[[list[bytes]], tuple[list[int], Iterable[int]]],
        remembered: int = REMEMBERED,
    ) -> None:
        self.table, self.merge, self.remembered = table, merge, remembered
        self.known: dict[bytes, bytes] = {}  # packed ids
        self.older: dict[bytes, bytes] = {}

    def _merged(self, some: list[bytes]) -> list[bytes]:
        parts = list(map(self.older.get, some))
        new = [i for i, own in enumerate(parts) if own is None]
        for start in range(0, len(new), MERGED):
            at = new[start : start + MERGED]
            for i, own in zip(at, packed(*self.merge([some[i] for i in at])), strict=True):
                parts[i] = own
        return parts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each text's ids end, with a 0 in front, and all ids. ``texts`` has no nulls."""
        found, counts = pieces(texts, self.table)
        coded = found.dictionary_encode()
        if len(self.known) > self.remembered // 3:
            self.known, self.older = {}, self.known
        distinct = _slices(coded.dictionary)
        parts = list(map(self.known.get, distinct))
        at = [i for i, own in enumerate(parts) if own is None]
        some = [distinct[i] for i in at]
        for i, piece, own in zip(at, some, self._merged(some), strict=True):
            parts[i] = self.known[piece] = own
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        lists = pa.LargeListArray.from_arrays(
            np.append(0, np.cumsum(sizes)), pa.array(np.frombuffer(b"".join(parts), np.int32))
        ).take(coded.indices)
        ends = lists.offsets.to_numpy()
        return ends[np.append(0, np.cumsum(counts))], lists.values.to_numpy()
