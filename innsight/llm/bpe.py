"""Byte-pair encoding as a streaming transducer, and its decoder.

A token sequence is the encoding of a byte string exactly if every two neighbours
are: the encoding of the two tokens' bytes is those two tokens again. So each
prefix of a string has one possible last token, found from the prefixes before it,
and the encoding of the whole is the path of last tokens back from its end.

The merge list's sufficient lookahead is the length of its longest token less one:
a later token can start no further back. A token is stable, and is emitted, once
the paths back from all those boundaries run through its end. Only what lies
behind the last stable boundary is kept.
"""

from __future__ import annotations

import json

import regex

#: Letters and numbers of later versions of Unicode than the tokenizer library's, to which they are neither.
LATER = (
    r"\u0558\u058B-\u058C\u088F\u0C5C\u0CDC\u208F\u209D-\u209F\uA7CE-\uA7CF\uA7D2\uA7D4\uA7DD\uA7E2\uA7F1\uAB6C-\uAB6D"
    r"\U000107BB-\U000107BF\U00010940-\U00010959\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A"
    r"\U00011DB0-\U00011DDB\U00011DE0-\U00011DE9\U00011DF1\U0001246F\U00012475-\U0001247F\U00012550-\U00012686"
    r"\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3\U00016FF2-\U00016FF6\U000187F8-\U000187FF\U00018CD6-\U00018CDA"
    r"\U00018D09-\U00018D20\U00018D80-\U00018DF2\U00018E00-\U00019191\U000191A0-\U000191D2\U0001B123-\U0001B128"
    r"\U0001B168\U0001D6A6\U0001DF1F-\U0001DF24\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF"
    r"\U0001E6C0-\U0001E6DE\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4"
    r"\U0001E6FE-\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD\U000323B0-\U00033479"
    r"\U0003D000-\U0003FC3F"
)
_LETTER, _NUMBER = rf"[\p{{L}}--[{LATER}]]", rf"[\p{{N}}--[{LATER}]]"
#: Fixed value: how the vocabulary's trainer splits a text before merging.
PATTERN = (
    rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{_LETTER}+| ?{_NUMBER}+| ?[[^\p{{White_Space}}\p{{L}}\p{{N}}]{LATER}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Characters read at a time, and entries of a worker's caches.
BLOCK = 1 << 16
CACHED = 200_000
CACHED_CHARS = 64
#: Pairs of neighbouring tokens that a worker remembers.
PAIRS = 500_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: a printable byte for itself, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


class MergeList:
    """Vocabulary, merges and what follows from them."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        letter = byte_letters()
        raw = lambda token: bytes(letter[c] for c in token)
        model = found["model"]
        self.special = {t["content"]: t["id"] for t in found.get("added_tokens", [])}
        self.id_of = {raw(t): n for t, n in model["vocab"].items() if t not in self.special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(raw(a), raw(b)): n for n, (a, b) in enumerate(pairs)}
        self.bytes_of: list[bytes] = [b""] * (max([*self.id_of.values(), *self.special.values()]) + 1)
        for token, n in self.id_of.items():
            self.bytes_of[n] = token
        for token, n in self.special.items():
            self.bytes_of[n] = token.encode()
        #: What a merge makes is no longer than this and one byte, so no token reaches further back.
        self.lookahead = max((len(a) + len(b) for a, b in self.rank), default=1) - 1
        self.length = [len(token) for token in self.bytes_of]
        self._suffixes()
        self.fits: dict[int, bool] = {}

    def _suffixes(self) -> None:
        """Which tokens end at a place, the longest first, by one state per prefix of a token.

        A string's state is its longest end that begins a token; ``longest`` has the longest token that ends
        there (-1: none) and ``shorter`` the next one of each token.
        """
        self.steps: dict[int, int] = {}
        self.fallback, self.longest, self.shorter = [0], [-1], [-1] * len(self.bytes_of)
        found: list[list[tuple[int, int]]] = []  # by depth: (step, state)
        for token, n in self.id_of.items():
            state = 0
            for depth, byte in enumerate(token):
                step = state << 8 | byte
                state = self.steps.get(step, 0)
                if not state:
                    state = self.steps[step] = len(self.longest)
                    self.fallback.append(0)
                    self.longest.append(-1)
                    if depth == len(found):
                        found.append([])
                    found[depth].append((step, state))
            if state:
                self.longest[state] = n
        for depth, level in enumerate(found):
            for step, state in level:
                back = self.step(self.fallback[step >> 8], step & 255) if depth else 0
                self.fallback[state] = back
                if self.longest[state] < 0:
                    self.longest[state] = self.longest[back]
                else:
                    self.shorter[self.longest[state]] = self.longest[back]
        self.steps_kept = len(self.steps) + PAIRS

    def step(self, state: int, byte: int) -> int:
        """The state after one more byte."""
        steps = self.steps
        found = steps.get(state << 8 | byte)
        while found is None and state:
            state = self.fallback[state]
            found = steps.get(state << 8 | byte)
        return found or 0

    def fresh_step(self, state: int, byte: int) -> int:
        """:meth:`step`, remembered."""
        found = self.step(state, byte)
        if len(self.steps) < self.steps_kept:
            self.steps[state << 8 | byte] = found
        return found

    def apart(self, left: bytes, right: bytes) -> bool:
        """Whether merging the joined bytes, the pair of least rank and leftmost first, gives these two tokens again.

        The definition, for short strings. Either may be empty: then whether the other is a token of its own bytes.
        """
        data, rank = left + right, self.rank.get
        parts, border = [data[k : k + 1] for k in range(len(data))], len(left)
        while len(parts) > 1:
            best, at = None, -1
            before = parts[0]
            for k in range(1, len(parts)):
                part = parts[k]
                r = rank((before, part))
                if r is not None and (best is None or r < best):
                    best, at = r, k
                before = part
            if best is None:
                break
            if at == border:
                return False
            parts[at - 1 : at + 1] = [parts[at - 1] + parts[at]]
            if at < border:
                border -= 1
        return parts == [token for token in (left, right) if token]

    def neighbours(self, a: int, b: int) -> bool:
        """Whether token ``b`` can follow token ``a`` (``a`` = -1: whether ``b`` is a token of its own bytes)."""
        key = (a << 20) | b if a >= 0 else -b - 1
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > PAIRS:
                self.fits.clear()
            known = self.fits[key] = self.apart(self.bytes_of[a] if a >= 0 else b"", self.bytes_of[b])
        return known


class Transducer:
    """Bytes of one pre-token in, stable tokens out."""

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.data = b""  # bytes behind the last stable boundary
        self.last = [-1]  # for each boundary the id of the last token, None until asked for; at 0 the last stable token
        self.ends = [-1]  # and the longest token that ends there
        self.state = 0  # of all bytes so far

    def feed(self, data: bytes) -> list[int]:
        m = self.merges
        steps, longest, fresh, state, ends = m.steps.get, m.longest, m.fresh_step, self.state, self.ends
        for byte in data:
            known = steps(state << 8 | byte)
            state = fresh(state, byte) if known is None else known
            ends.append(longest[state])
        self.last += [None] * len(data)
        self.data += data
        self.state = state
        return self._stable() if len(self.data) > 2 * m.lookahead else []

    def _last(self, end: int) -> int:
        """The last token of the bytes up to a boundary: the longest that ends there and can follow what it leaves.

        What it leaves is asked for in turn, and only that.
        """
        m, last, ends = self.merges, self.last, self.ends
        fits, shorter, length = m.fits.get, m.shorter, m.length
        asked = [(end, ends[end])]
        while asked:
            at, n = asked.pop()
            while n >= 0:
                start = at - length[n]
                if start >= 0:
                    before = last[start]
                    if before is None:
                        asked.append((at, n))
                        at, n = start, ends[start]
                        continue
                    ok = fits((before << 20) | n if before >= 0 else -n - 1)
                    if ok or (ok is None and m.neighbours(before, n)):
                        break
                n = shorter[n]
            else:
                raise ValueError("the vocabulary lacks a byte")
            last[at] = n
        return last[end]

    def _before(self, end: int) -> int:
        """The boundary that the last token before one leaves."""
        found = self.last[end]
        return end - self.merges.length[self._last(end) if found is None else found]

    def _back(self, end: int) -> list[int]:
        path = [end]
        while path[-1]:
            path.append(self._before(path[-1]))
        return path

    def _stable(self) -> list[int]:
        """Emit up to the last boundary on the paths from all boundaries a later token can start at."""
        end = len(self.data)
        alive = set(range(max(0, end - self.merges.lookahead), end + 1))
        while len(alive) > 1:
            far = max(alive)
            alive.remove(far)
            alive.add(self._before(far))
        stop = alive.pop()
        if stop == 0:
            return []
        out = [self.last[k] for k in reversed(self._back(stop)[:-1])]
        self.data, self.last, self.ends = self.data[stop:], self.last[stop:], self.ends[stop:]
        return out

    def finish(self) -> list[int]:
        out = [self.last[k] for k in reversed(self._back(len(self.data))[:-1])]
        self.data, self.last, self.ends, self.state = b"", [-1], [-1], 0
        return out


class Encoder:
    """Text in pieces of any size in, token ids out; memory does not grow with the text."""

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.split = regex.compile(PATTERN).findall
        self.match = regex.compile(PATTERN).match
        marks = sorted(merges.special, key=len, reverse=True)
        self.marks = regex.compile("|".join(map(regex.escape, marks))) if marks else None
        self.known: dict[str, tuple[int, ...]] = {}
        self.chunks: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def pre_token(self, piece: str) -> tuple[int, ...]:
        found = self.known.get(piece)
        if found is None:
            transducer = Transducer(self.merges)
            found = (*transducer.feed(piece.encode()), *transducer.finish())
            if len(piece) <= CACHED_CHARS:
                if len(self.known) >= CACHED:
                    self.known.clear()
                self.known[piece] = found
        return found

    def _plain(self, pieces: list[str], out: list[int]) -> None:
        known = self.known
        for piece in pieces:
            ids = known.get(piece)
            out.extend(self.pre_token(piece) if ids is None else ids)

    def _chunk(self, chunk: str) -> tuple[int, ...] | None:
        """Ids of a stretch up to the next blank or line feed; None if white space reaches past its end."""
        if not chunk or chunk[-1].isspace():
            return None
        ids = self.older.get(chunk)
        if ids is not None:
            self.chunks[chunk] = ids
            return ids
        out: list[int] = []
        # Letters of ASCII alone are one pre-token with the blank before them.
        whole = chunk.isascii() and chunk.isalpha()
        self._plain([" " + chunk] if whole else self.split(chunk if chunk[0] == "\n" else " " + chunk), out)
        ids = tuple(out)
        if len(chunk) <= CACHED_CHARS:
            if len(self.chunks) >= CACHED:
                self.older, self.chunks = self.chunks, {}
            self.chunks[chunk] = ids
        return ids

    def _text(self, text: str) -> list[int]:
        """Ids of a whole stretch of text.

        No pre-token runs over a single blank or line feed between other
        characters, so what stands between two of them is looked up as one. A
        stretch with longer white space is split by the pattern.
        """
        parts = text.replace("\n", " \n").split(" ")
        out: list[int] = []
        if parts[0] and not parts[0][-1].isspace():
            self._plain(self.split(parts[0]), out)
            for part in parts[1:]:
                ids = self.chunks.get(part)
                if ids is None:
                    ids = self._chunk(part)
                    if ids is None:
                        break
                out += ids
            else:
                return out
        out = []
        self._plain(self.split(text), out)
        return out

    def blocks(self, text: str, block: int = BLOCK):
        """Ids of a text in lists, a block of it at a time.

        A block is cut before its last single blank, else before its last
        pre-token but one, since no more text can change what lies before. A
        pre-token longer than a block goes to the transducer in parts.
        """
        for part, mark in self._parts(text):
            at, size = 0, len(part)
            while size - at > block:
                piece = part[at : at + block]
                cut = piece.rfind(" ", 0, block - 1)
                if cut > 0 and not piece[cut - 1].isspace() and not piece[cut + 1].isspace():
                    at += cut
                    yield self._text(piece[:cut])
                    continue
                pieces = self.split(piece)
                if len(pieces) > 2:
                    out: list[int] = []
                    self._plain(pieces[:-2], out)
                    at += block - len(pieces[-1]) - len(pieces[-2])
                    yield out
                else:
                    stop = self.match(part, at).end()
                    transducer = Transducer(self.merges)
                    for k in range(at, stop, block):
                        yield transducer.feed(part[k : min(k + block, stop)].encode())
                    yield transducer.finish()
                    at = stop
            out = self._text(part[at:] if at else part)
            if mark is not None:
                out.append(mark)
            yield out

    def _parts(self, text: str):
        """Stretches of ordinary text, each with the special token after it."""
        at = 0
        if self.marks is not None:
            for found in self.marks.finditer(text):
                yield text[at : found.start()], self.merges.special[found.group()]
                at = found.end()
        yield (text[at:] if at else text), None

    def encode(self, text: str) -> list[int]:
        return [n for part in self.blocks(text) for n in part]


class Utf8Decoder:
    """Bytes in any pieces in, text out; between pieces only an unfinished character is kept.

    The longest part of a character that can't go on becomes one U+FFFD.
    """

    def __init__(self):
        self.rest = b""

    def feed(self, data: bytes, final: bool = False) -> str:
        data = self.rest + data
        self.rest = b""
        if not final:
            keep = self._unfinished(data)
            if keep:
                data, self.rest = data[:-keep], data[-keep:]
        return data.decode("utf-8", "replace")

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Bytes at the end that may be the start of a character."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                width = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4 if byte < 0xF5 else 0
                return back if back < width else 0
            if byte < 0x80:
                return 0
        return 0


class Decoder:
    def __init__(self, merges: MergeList):
        self.bytes_of = merges.bytes_of.__getitem__
        self.text = Utf8Decoder()

    def feed(self, ids: list[int], final: bool = False) -> str:
        return self.text.feed(b"".join(map(self.bytes_of, ids)), final)
