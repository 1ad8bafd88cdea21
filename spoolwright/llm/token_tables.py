"""Token ids and token counts of whole texts, by the tokenizers library.

ByteEncoder cuts texts where the pre-tokenizer provably starts anew and has the library's model encode distinct pieces once.
ChunkCounter encodes overlapping chunks of huge texts with offsets and splices them at boundaries that both chunks prove.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Byte classes of the byte-level pattern "'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+" (fixed value).
LETTER, DIGIT, SPACE, OTHER, ODD = range(5)
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123)]] = LETTER
_CLASS[48:58], _CLASS[[32, *range(9, 14)]] = DIGIT, SPACE
_CLASS[128:], _CLASS[128:192], _CLASS[195:202] = ODD, LETTER, LETTER  # bytes that continue a character, and that begin one of U+00C0 to U+027F
#: Characters that pieces of the byte-level pattern are not told apart for here.
NOT_LATIN = re.compile("[\x80-\xbf\u00d7\u00f7\u0250-\U0010ffff]")
#: The pre-token pattern of the file that drops white space (fixed value).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: That pattern for lower-cased ASCII words.
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: White space to Python but not to the tokenizers.
CONTROLS = re.compile("[\x1c-\x1f]")
#: White space between non-white space and an ASCII letter or digit.
GAP = re.compile(r"(?<=[^\s\x1c-\x1f])[ \n](?=[A-Za-z0-9])")


@functools.cache
def word_gaps(kept: str) -> re.Pattern:
    """Where the pre-token pattern of words begins anew whatever stands before: at white space before a letter or digit; between punctuation
    (but an apostrophe, and the characters of kept) and a letter; and between digits, each of which is a piece.

    Letters, digits and punctuation are those of the first plane that Unicode has had since version 3.2, as tables may differ in later ones.
    None of them composes with what stands before such a place, so normalisation works on either side alone.
    """
    old = unicodedata.ucd_3_2_0
    chars = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    group = lambda kinds: "".join(re.escape(c) for c in chars if old.category(c)[0] in kinds and c not in kept)
    letters, digits, marks = group("L"), "0-9", "".join(re.escape(c) for c in chars if old.category(c)[0] in "PS" and c not in kept + "'")
    return re.compile(rf"(?<=[^\s\x1c-\x1f])[ \n](?=[{letters}{digits}])|(?<=[{marks}])(?=[{letters}])|(?<=[{digits}])(?=[{digits}])")


def byte_alphabet() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


def load(path: str):
    """The tokenizer of a file, without truncation and padding, and what the file says."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t, json.loads(t.to_str())


def _plain_specials(file: dict) -> bool:
    """Whether added tokens are found as they stand in a text, and none holds or takes in white space."""
    return all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) and not re.search(r"\s", t["content"]) for t in file["added_tokens"])


def _steps(part: dict | None, key: str) -> list[dict]:
    return [] if part is None else part[key] if part["type"] == "Sequence" else [part]


def cuts_at_spaces(file: dict) -> bool:
    """Whether pre_tokens() holds for a file: no normaliser, and the byte-level pattern alone."""
    pre = file["pre_tokenizer"] or {}
    return file["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre["add_prefix_space"] and _plain_specials(file)


def drops_white_space(file: dict) -> bool:
    """Whether white space parts pre-tokens and is dropped, and no normaliser works across it."""
    changes, pre = _steps(file["normalizer"], "normalizers"), _steps(file["pre_tokenizer"], "pretokenizers")
    harmless = all(n["type"] in ("NFC", "Lowercase") or (n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " ") for n in changes)
    parts = bool(pre) and (pre[0]["type"] == "WhitespaceSplit" or (pre[0]["type"] == "Split" and pre[0]["pattern"] == {"Regex": WORD_PATTERN} and pre[0]["invert"] and pre[0]["behavior"] == "Removed"))
    return harmless and parts and _plain_specials(file)


def pre_tokens(data: np.ndarray, texts: np.ndarray, special: list[bytes]) -> np.ndarray:
    """Where the byte-level pattern begins a pre-token in the UTF-8 bytes of texts that start and end where `texts` says.

    Between two spaces that a non-space follows, a stretch with a special string, or with a character that is neither ASCII nor a Latin
    letter, is one piece: the pattern starts anew at such a space whatever stands before, as none of its alternatives runs across a
    space into a non-space but from that space on.
    """
    n = len(data)
    kind = _CLASS[data]
    edge = np.zeros(n + 1, bool)
    edge[texts] = True
    new = np.ones(n + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=new[1:n])
    new |= edge
    space = np.flatnonzero(kind == SPACE)
    last = space[new[space + 1] & ~edge[space + 1]]  # of white space before something else
    new[last] = True
    joined = last[data[last] == 32]
    new[joined + 1] = False
    after = np.append(data, np.zeros(3, np.uint8))
    quote = np.flatnonzero(data == 39)
    quote = quote[new[quote] & new[quote + 1] & ~edge[quote + 1]]
    one = quote[np.isin(after[quote + 1], list(b"stmd"))]
    two = quote[~edge[np.minimum(quote + 2, n)]]
    pair = after[two + 1].astype(np.int64) << 8 | after[two + 2]
    two = two[np.isin(pair, [x[0] << 8 | x[1] for x in (b"re", b"ve", b"ll")])]
    new[one + 1] = new[two + 1] = False
    new[one + 2] = new[two + 3] = True
    odd = [np.flatnonzero(kind == ODD)]
    for lead, low, high in ((0xC3, 0x97, 0x97), (0xC3, 0xB7, 0xB7), (0xC9, 0x90, 0xBF)):
        at = np.flatnonzero(data == lead)
        odd.append(at[(after[at + 1] >= low) & (after[at + 1] <= high)])
    raw = data.tobytes() if special else b""
    odd += [np.array([m.start() for m in re.finditer(re.escape(x), raw)], np.int64) for x in special]
    odd = np.concatenate(odd)
    starts = np.flatnonzero(new[:n])
    if not len(odd):
        return starts
    cuts = np.unique(np.concatenate([texts[texts < n], joined[kind[joined + 1] != ODD]]))
    whole = np.zeros(len(cuts), bool)
    whole[np.searchsorted(cuts, odd, "right") - 1] = True
    mine = np.searchsorted(cuts, starts, "right") - 1
    return starts[~whole[mine] | (cuts[mine] == starts)]


class ByteEncoder:
    """Ids of whole texts, equal to Tokenizer.encode(text, add_special_tokens=False).ids.

    The distinct pre-tokens of a batch are encoded once, by the library's model, and stretches that pre_tokens() leaves whole by the
    library. Recent ones are kept, within a bound on their bytes. A file with another pre-tokenizer has its texts encoded whole.
    """

    def __init__(self, path: str, most_bytes: int = 64 << 20, gather: int = 1 << 20):
        self.tokenizer, file = load(path)
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.cuts, self.most, self.gather = cuts_at_spaces(file), most_bytes, gather
        special = [t["content"] for t in file["added_tokens"]]
        self.special, self.library = [s.encode() for s in special], re.compile("|".join([NOT_LATIN.pattern, *map(re.escape, special)]))
        self.model, self.alphabet = self.tokenizer.model, byte_alphabet()
        self.number: dict[str, int] = {}  # of a piece; its ids stand in the table behind those of the numbers before
        self.sizes, self.uses, self.table, self.used, self.held = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, self.type), 0, 0

    def forget(self) -> None:
        """Drop pieces that one batch only has used; all of them if the others are more than half of what may be held."""
        n = len(self.number)
        keep = self.uses[:n] > 1
        names = [u for u, k in zip(self.number, keep.tolist(), strict=True) if k]
        sizes, table = self.sizes[:n][keep], self.table[: self.used][np.repeat(keep, self.sizes[:n])]
        self.number, self.used, self.held = {}, 0, 0
        if self.room(names, table) <= self.most // 2:
            self.add(names, sizes, table)

    def room(self, units: list[str], ids: np.ndarray) -> int:
        return 220 * len(units) + sum(map(len, units)) + 3 * ids.nbytes

    def add(self, units: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        n, used = len(self.number), self.used
        if n + len(units) > len(self.sizes):
            more = n + 2 * len(units)
            self.sizes, self.uses = np.concatenate([self.sizes[:n], np.empty(more, np.int64)]), np.concatenate([self.uses[:n], np.empty(more, np.int32)])
        if used + len(ids) > len(self.table):
            self.table = np.concatenate([self.table[:used], np.empty(used + 2 * len(ids), self.type)])
        self.sizes[n : n + len(units)], self.uses[n : n + len(units)], self.table[used : used + len(ids)] = sizes, 0, ids
        self.number.update(zip(units, range(n, n + len(units)), strict=True))
        self.used += len(ids)
        self.held += self.room(units, ids)

    def ids(self, piece: str) -> list[int]:
        if self.library.search(piece):
            return self.tokenizer.encode(piece, add_special_tokens=False).ids
        byte = piece if piece.isascii() else piece.encode().decode("latin-1")
        return [t.id for t in self.model.tokenize(byte.translate(self.alphabet))]

    def learn(self, pieces: list[str]) -> None:
        fresh = list(map(self.ids, pieces))
        sizes = np.fromiter(map(len, fresh), np.int64, len(fresh))
        self.add(pieces, sizes, np.fromiter(chain.from_iterable(fresh), self.type, int(sizes.sum())))

    def numbers(self, pieces: list[str]) -> np.ndarray:
        try:
            return np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        except KeyError:
            self.learn([p for p in pieces if p not in self.number])
            return np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts after one another, where each text's begin, and the end): nulls count as empty; end_id follows each text if given."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        tail = 0 if end_id is None else 1
        if not len(texts):
            return np.empty(0, self.type), np.zeros(1, np.int64)
        if not self.cuts:
            rows = [np.array(e.ids + [end_id] * tail, self.type) for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate(rows), np.concatenate(([0], np.cumsum([len(r) for r in rows])))
        if self.held > self.most:
            self.forget()
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
        data = np.frombuffer(data, np.uint8, int(at[-1] - at[0]), int(at[0])) if data else np.empty(0, np.uint8)
        at = at - at[0]
        begins = pre_tokens(data, at, self.special)
        pieces = pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(np.append(begins, len(data))), pa.py_buffer(data)])
        starts = np.searchsorted(begins, at)
        coded = pieces.dictionary_encode()
        codes = coded.indices.to_numpy()
        numbers = self.numbers(coded.dictionary.to_pylist())
        self.uses[numbers] += 1
        known = self.sizes[: len(self.number)]
        size, at = known[numbers], (np.cumsum(known) - known)[numbers]
        n = size[codes]
        ends = np.cumsum(n)
        bounds = np.concatenate(([0], ends))[starts] + np.arange(len(texts) + 1) * tail
        to = ends - n + np.repeat(np.arange(len(texts)), np.diff(starts)) * tail  # where a piece's ids go
        out = np.empty(int(bounds[-1]), self.type)
        for first in range(0, len(codes), self.gather):
            part = slice(first, first + self.gather)
            m = n[part]
            step = np.cumsum(m) - m
            here = np.arange(int(m.sum()))
            out[np.repeat(to[part] - step, m) + here] = self.table[np.repeat(at[codes[part]] - step, m) + here]
        if tail:
            out[bounds[1:] - 1] = end_id
        return out, bounds


class ChunkCounter:
    """Token counts of whole texts, as Tokenizer.encode gives them; huge ones by overlap resynchronisation.

    A text of more than `chunk` characters is encoded in chunks that overlap by `overlap` characters or more. Two neighbours are spliced at a
    proven boundary of their overlap: a place where the pre-tokenizer starts anew whatever stands before and no normaliser works across,
    which no token of either chunk spans, and behind which both chunks have the same tokens at the same offsets up to the last such place
    of the overlap. Tokens before it are counted from the left chunk's encoding, those behind it from the right one's. Chunks are laid so
    that their overlaps hold such places; if their tokens do not agree all the same, the right chunk is encoded again with all that is not
    counted yet, and if that fails too, the text is counted once, whole, as is a text without any such place. Shorter texts are counted by their distinct words, which the library, or for ASCII
    its model, encodes once and which are kept within a bound on their bytes. A tokenizer file for which white space proves nothing has texts encoded whole.
    """

    def __init__(self, path: str, chunk: int = 16_384, overlap: int = 256, most_bytes: int = 64 << 20):
        self.tokenizer, file = load(path)
        self.chunk, self.overlap, self.proves = chunk, max(1, min(overlap, chunk // 2)), drops_white_space(file)
        self.words, self.held, self.most = {}, 0, most_bytes
        pre = _steps(file["pre_tokenizer"], "pretokenizers")
        lowers = any(n["type"] == "Lowercase" for n in _steps(file["normalizer"], "normalizers"))
        self.by_model = self.proves and lowers and [p["type"] for p in pre] == ["Split", "ByteLevel"] and not pre[1].get("use_regex", True) and not pre[1]["add_prefix_space"]
        by_words = bool(pre) and pre[0]["type"] == "Split"
        self.gap = word_gaps("".join(sorted({c for t in file["added_tokens"] for c in t["content"] if not c.isalnum()}))) if self.proves and by_words else GAP
        self.special = re.compile("|".join(re.escape(t["content"]) for t in file["added_tokens"]) or r"(?!)")
        self.model, self.alphabet = self.tokenizer.model, byte_alphabet()
        self.calls = self.characters = 0  # pieces that the library encoded, and their length

    def encoded(self, pieces: list[str]) -> list:
        self.calls += len(pieces)
        self.characters += sum(map(len, pieces))
        return self.tokenizer.encode_batch(pieces, add_special_tokens=False)

    def counts(self, texts: list[str | None]) -> list[int]:
        out = [0] * len(texts)
        whole, split = [], {}
        for i, t in enumerate(texts):
            if t and self.proves and len(t) > self.chunk:
                out[i] = self.spliced(t)
            elif t and self.proves and not CONTROLS.search(t):
                split[i] = t.split()
            elif t:
                whole.append(i)
        for i, e in zip(whole, self.encoded([texts[i] for i in whole]) if whole else [], strict=True):
            out[i] = len(e)
        # white space parts pre-tokens and is dropped, so the counts of a short text's words add up; distinct ones are encoded once
        if self.held > self.most:
            self.words, self.held = {}, 0
        new = list({w for ws in split.values() for w in ws}.difference(self.words))
        if new:
            plain = [w for w in new if self.by_model and w.isascii() and not self.special.search(w)]
            for w in plain:
                self.words[w] = sum(len(self.model.tokenize(p.translate(self.alphabet))) for p in ASCII_WORDS.findall(w.lower()))
            other = [w for w in new if w not in self.words]
            self.words.update(zip(other, map(len, self.encoded(other) if other else []), strict=True))
            self.held += sum(map(len, new)) + 150 * len(new)
        for i, ws in split.items():
            out[i] = sum(map(self.words.__getitem__, ws))
        return out

    def placed(self, text: str, start: int, end: int) -> tuple[int, int, np.ndarray, np.ndarray]:
        """A chunk: its range of the text, its ids, and the range of every token in the text."""
        (e,) = self.encoded([text[start:end]])
        return start, end, np.array(e.ids, np.int64), np.array(e.offsets, np.int64).reshape(-1, 2) + start

    def ranges(self, text: str):
        """The chunks of a text: each begins in the latter half of the one before, and two possible boundaries lie where they overlap.

        What is looked at are characters, not yet tokens. Where the latter half holds no two boundaries, the chunk goes on to the second one
        behind it, and to the end of the text if there is none. So no character stands in more than two chunks.
        """
        begin = 0
        while begin + self.chunk < len(text):
            half, end = begin + self.chunk // 2, begin + self.chunk
            back, found = self.overlap, []
            while len(found) < 2 and back:
                low = max(half, end - back)
                found = [m.start() for m in self.gap.finditer(text, low, end)]
                back = 4 * back if low > half else 0
            if len(found) < 2:
                found = [m.start() for m, _ in zip(self.gap.finditer(text, half), range(2), strict=False)]
                if len(found) < 2:
                    break
                end = min(len(text), found[1] + 2)
                after = found[0] - 1
            else:
                after = min(found[-2] - 1, end - self.overlap)
            yield begin, end
            if end == len(text):
                return
            begin = max(after, half - 1, begin + 1)
        yield begin, len(text)

    def spliced(self, text: str) -> int:
        total, counted, left = 0, 0, None  # tokens so far, and the place in the text up to which they go
        for begin, end in self.ranges(text):
            right = self.placed(text, begin, end)
            if left is not None:
                cut = self.boundary(text, left, right, counted)
                if cut is None and begin > max(counted, left[0]):  # alignment failed: the overlap is widened to all that is not counted yet
                    right = self.placed(text, max(counted, left[0]), end)
                    cut = self.boundary(text, left, right, counted)
                if cut is None:
                    return len(self.encoded([text])[0])
                total += self.between(left, counted, cut)
                counted = cut
            left = right
        return total + self.between(left, counted, len(text))

    def between(self, chunk: tuple, start: int, end: int) -> int:
        """The chunk's tokens that stand in a range of the text."""
        return int(np.searchsorted(chunk[3][:, 0], end) - np.searchsorted(chunk[3][:, 0], start))

    def boundary(self, text: str, left: tuple, right: tuple, counted: int) -> int | None:
        """The last proven boundary in the overlap, behind what is counted already; None if there is none."""
        gaps = [m.start() for m in self.gap.finditer(text, max(right[0], counted) + 1, left[1])]
        if len(gaps) < 2:
            return None
        upto = gaps[-1]  # behind it the left chunk may break off within a word
        for g in reversed(gaps[:-1]):
            (a, b), (c, d) = (np.searchsorted(x[3][:, 0], (g, upto)) for x in (left, right))
            spans = (a and left[3][a - 1, 1] > g) or (c and right[3][c - 1, 1] > g)
            if not spans and b - a == d - c > 0 and (left[2][a:b] == right[2][c:d]).all() and (left[3][a:b] == right[3][c:d]).all():
                return g
        return None
