"""Byte-level BPE as a streaming transducer with bounded lookahead, and its inverse.

Texts are fed in portions of ``PORTION`` characters. What may still change is
held back: three characters that decide how the text before them is split, and
a piece that is still open.

A boundary between two tokens can be crossed by a later merge only if a token
forms right after it, and what forms there depends on a bounded stretch of text.
``sufficient_lookahead`` computes that stretch from the merge list. The encoder
keeps one open piece of text; once the piece is longer than the lookahead, the
tokens that end before it are emitted, so memory is constant however long a
piece is. The decoder keeps at most the bytes of one unfinished character.

Defined cases: a null text counts as empty and has no ids; null ids give an empty
text; repeated rows are encoded one by one; an empty table gives an empty result;
there are no ties, as ranks differ. A very long text takes, besides its own ids, the memory of a portion.
Special tokens of the file are matched in the text, as the file's library does.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from hopscope.llm import words

# Fixed value: the splitting rule of byte-level BPE.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^{space}{letter}{number}]+|{S}+(?!{notS})|{S}+"""
_CLASSES = {"L": r"\p{L}", "N": r"\p{N}", "S": r"\p{White_Space}", "notS": r"\P{White_Space}"}
_CLASSES |= {"letter": _CLASSES["L"], "number": _CLASSES["N"], "space": _CLASSES["S"]}
_FAR = re.compile("[\U00010000-\U0010ffff]")


def _near_classes() -> dict[str, str]:
    """The same classes spelt out for code points below 65536, where the ``re`` module tests sets by table."""
    out = {}
    for name, category in (("letter", "L"), ("number", "N"), ("space", "White_Space")):
        have = regex.compile(r"\p{%s}+" % category)
        runs = have.finditer("".join(map(chr, range(0x10000))))
        out[name] = "".join(rf"\u{m.start():04x}-\u{m.end() - 1:04x}" for m in runs)
    short = {"L": "letter", "N": "number", "S": "space"}
    return out | {k: f"[{out[v]}]" for k, v in short.items()} | {"notS": f"[^{out['space']}]"}


@cache
def _splitters():
    """(pattern for texts of near code points, pattern for all)."""
    return re.compile(PIECES.format(**_near_classes())), regex.compile(PIECES.format(**_CLASSES))


# How an open piece goes on, by the kind of its last character.
_ON = {
    "letter": regex.compile(r"\p{L}*"),
    "number": regex.compile(r"\p{N}*"),
    "other": regex.compile(r"[^\p{White_Space}\p{L}\p{N}]*"),
    "space": regex.compile(r"\p{White_Space}*"),
}
_KIND = regex.compile(r"(\p{L})|(\p{N})|(\p{White_Space})|(.)", regex.S)
_DECODE_ROWS = 256
_ENCODE_BYTES = 1 << 20  # texts taken from a batch at once
PORTION = 1 << 16  # characters fed to the encoder at once
_MEMO = 1 << 17  # pieces whose ids are kept
_MEMO_LENGTH = 64
_HOLD = 3  # characters that can still change how the text before them is split
SHORT = 64
_NEVER = np.int32((1 << 31) - 1)


def byte_alphabet() -> dict[str, int]:
    """Printable bytes stand for themselves, the others for the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merge ranks and special tokens of a byte-level BPE file."""

    def __init__(self, source: str):
        spec = json.loads(source)
        alphabet = byte_alphabet()
        to_bytes = lambda token: bytes(alphabet[c] for c in token)
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t.get(k) for t in spec.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError("special tokens that take in white space or need a word border aren't supported")
        self.ids = {to_bytes(t): i for t, i in model["vocab"].items() if t not in self.special}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merges = [(to_bytes(a), to_bytes(b)) for a, b in pairs]
        self.ranks = {(self.ids[a], self.ids[b]): r for r, (a, b) in enumerate(self.merges)}
        self.made = [self.ids[a + b] for a, b in self.merges]
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.bytes = {i: t for t, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.lookahead = sufficient_lookahead(self.merges)

    @cached_property
    def table(self) -> PairTable:
        """For ``merge_many``."""
        return PairTable(self.ranks)


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after a place that decide whether a token boundary stands there.

    A token t forms unless, earlier, a part s at its right edge merges with a
    token v that follows: a rule (s, v) of a lower rank than the rule that
    takes s into t. So t depends on len(v) bytes and on what v depends on; v is
    older than that rule, and the rule older than t, so the ranks go down and
    one pass in rank order ends.
    """
    rank = {a + b: r for r, (a, b) in enumerate(merges)}
    right = {a + b: b for a, b in merges}
    depends: dict[bytes, int] = {}
    # For each left part: ranks of its rules so far, and the most bytes any of them reaches to.
    rules: dict[bytes, tuple[list[int], list[int]]] = {}
    most = 1
    for r, (a, b) in enumerate(merges):
        if rank.get(b, -1) >= r or rank.get(a, -1) >= r:
            raise ValueError("a merge uses a token that only a later merge makes")
        token, reach, whole = a + b, 0, a + b
        while whole in right:
            part = right[whole]
            if part in rules:
                ranks, reaches = rules[part]
                n = bisect_left(ranks, rank[whole])
                if n:
                    reach = max(reach, reaches[n - 1])
            whole = part
        depends[token] = reach
        ranks, reaches = rules.setdefault(a, ([], []))
        ranks.append(r)
        reaches.append(max(len(b) + depends.get(b, 0), reaches[-1] if reaches else 0))
        most = max(most, len(token) + reach)
    return most


def merge(vocabulary: Vocabulary, piece: bytes) -> list[int]:
    """Ids of one piece: the lowest rank merges first, the leftmost of equal ones."""
    ids = [vocabulary.single[b] for b in piece]
    ranks, made = vocabulary.ranks, vocabulary.made
    if len(ids) <= SHORT:
        rank = ranks.get
        pairs = [rank(p, _NEVER) for p in zip(ids, ids[1:])]
        while pairs and (least := min(pairs)) < _NEVER:
            i = pairs.index(least)
            ids[i] = made[least]
            del ids[i + 1], pairs[i]
            if i:
                pairs[i - 1] = rank((ids[i - 1], ids[i]), _NEVER)
            if i < len(pairs):
                pairs[i] = rank((ids[i], ids[i + 1]), _NEVER)
        return ids
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    queue = [(ranks[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
    heapq.heapify(queue)
    gone, end = [False] * len(ids), len(ids)
    while queue:
        least, i = heapq.heappop(queue)
        j = end if gone[i] else after[i]
        if j >= end or ranks.get((ids[i], ids[j])) != least:
            continue
        ids[i], gone[j], after[i] = made[least], True, after[j]
        if after[i] < end:
            before[after[i]] = i
            if (r := ranks.get((ids[i], ids[after[i]]))) is not None:
                heapq.heappush(queue, (r, i))
        if before[i] >= 0 and (r := ranks.get((ids[before[i]], ids[i]))) is not None:
            heapq.heappush(queue, (r, before[i]))
    return [x for x, dead in zip(ids, gone, strict=True) if not dead]


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class PairTable:
    """Ranks of pairs of ids for whole arrays: a hash table in two arrays, probed in line."""

    def __init__(self, ranks: dict[tuple[int, int], int]):
        self.bits = max(4, len(ranks).bit_length() + 2)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NEVER, np.int32)
        for (a, b), r in ranks.items():
            at = int(self._slot(np.array([a << 32 | b]))[0])
            while self.keys[at] != -1:
                at = (at + 1) & (len(self.keys) - 1)
            self.keys[at], self.values[at] = a << 32 | b, r

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = self._slot(key)
        seen = self.keys[at]
        out = np.where(seen == key, self.values[at], _NEVER)
        open_ = np.flatnonzero((seen != key) & (seen != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            seen = self.keys[at[open_]]
            hit = seen == key[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (seen != -1)]
        return out


def merge_many(vocabulary: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many pieces at once (bytes and offsets), and offsets into them.

    Each round merges the best pair of every piece that still has one.
    """
    made = np.array(vocabulary.made, np.int32)
    lens = np.diff(offsets)
    sizes = np.zeros(len(lens), np.int64)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    piece = np.flatnonzero(lens)
    lens = lens[piece]
    ids = np.array(vocabulary.single, np.int32)[data]
    ends = np.cumsum(lens)
    rank = np.full(len(ids), _NEVER, np.int32)
    if len(ids) > 1:
        rank[:-1] = vocabulary.table.ranks(ids[:-1], ids[1:])
    rank[ends - 1] = _NEVER
    while len(piece):
        starts = np.cumsum(lens) - lens
        least = np.minimum.reduceat(rank, starts)
        go = least < _NEVER
        if not go.all():
            stop = np.repeat(~go, lens)
            done.append((piece[~go], lens[~go], ids[stop]))
            sizes[piece[~go]] = lens[~go]
            ids, rank = ids[~stop], rank[~stop]
            piece, lens, least = piece[go], lens[go], least[go]
            if not len(piece):
                break
            starts = np.cumsum(lens) - lens
        owner = np.repeat(np.arange(len(piece)), lens)
        hits = np.flatnonzero(rank == least[owner])
        of = owner[hits]
        at = hits[np.concatenate([[True], of[1:] != of[:-1]])]
        ids[at] = made[least]
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        ids, rank = ids[keep], rank[keep]
        at = at - np.arange(len(at))
        lens = lens - 1
        ends = np.cumsum(lens)
        last = at == ends - 1
        rank[at[last]] = _NEVER
        inner = at[~last]
        rank[inner] = vocabulary.table.ranks(ids[inner], ids[inner + 1])
        inner = at[at > ends - lens]
        rank[inner - 1] = vocabulary.table.ranks(ids[inner - 1], ids[inner])
    place = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(place[-1], np.int32)
    for piece, lens, made_ids in done:
        out[np.repeat(place[piece] - (np.cumsum(lens) - lens), lens) + np.arange(len(made_ids))] = made_ids
    return out, place


class Encoder:
    """``feed`` text in any portions, then ``finish``; both return the ids settled by then, as an int array."""

    def __init__(self, vocabulary: Vocabulary, window: int = 4096):
        self.vocabulary = vocabulary
        self.window = max(window, 2 * vocabulary.lookahead)
        self.near, self.far = _splitters()
        self.specials = sorted(vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.memo: dict[str, bytes] = {}
        self._reset()

    def _reset(self) -> None:
        self.text = ""  # not yet split
        self.open = b""  # of a piece that has begun to be emitted
        self.kind = ""

    def feed(self, text: str) -> array:
        self.text += text
        out = bytearray()
        if self.special is None:
            return array("i", bytes(self._advance(out, False)))
        found = self.special.split(self.text)
        for before, token in zip(found[:-1:2], found[1::2], strict=True):
            self.text = before
            self._advance(out, True)
            out += _packed([self.vocabulary.special[token]])
        self.text = found[-1]
        # A special token may have begun at the end.
        begun = range(min(len(self.text), len(self.specials[0]) - 1), 0, -1)
        tail = next((n for n in begun if any(s.startswith(self.text[-n:]) for s in self.specials)), 0)
        cut = len(self.text) - tail
        kept, self.text = self.text[cut:], self.text[:cut]
        self._advance(out, False)
        self.text += kept
        return array("i", bytes(out))

    def prime(self, texts: list[str | None]) -> None:
        """Work out the ids of the short pieces these texts hold all at once, ahead of feeding them.

        A piece cut by a portion's edge is merged when it is fed.
        """
        found: set[str] = set()
        for text in texts:
            for at in range(0, len(text or ""), PORTION):
                part = text[at : at + PORTION]
                found.update((self.far if _FAR.search(part) else self.near).findall(part))
        fresh = [p for p in found if len(p) <= _MEMO_LENGTH and p not in self.memo]
        if not fresh:
            return
        if len(self.memo) + len(fresh) > _MEMO:
            self.memo.clear()
        coded = [p.encode() for p in fresh]
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded])])
        flat, place = merge_many(self.vocabulary, np.frombuffer(b"".join(coded), np.uint8), offsets)
        data, place = flat.tobytes(), (4 * place).tolist()
        self.memo.update((p, data[a:b]) for p, a, b in zip(fresh, place, place[1:]))

    def finish(self) -> array:
        out = self._advance(bytearray(), True)
        self._reset()
        return array("i", bytes(out))

    def encode(self, text: str) -> array:
        out = array("i")
        for at in range(0, len(text), PORTION):
            out += self.feed(text[at : at + PORTION])
        return out + self.finish()

    def _advance(self, out: bytearray, last: bool) -> bytearray:
        if self.kind:
            self._go_on(out, last)
            if self.kind:
                return out
        pieces = (self.far if _FAR.search(self.text) else self.near).findall(self.text)
        if last:
            self.text = ""
        else:
            size, n, held = len(self.text), len(pieces), 0
            while n and (n == len(pieces) or held < _HOLD):
                n -= 1
                held += len(pieces[n])
            pieces, self.text = pieces[:n], self.text[size - held :]
        known = self.memo.get
        for piece in pieces:
            out += known(piece) or self._piece(piece)
        if not last and len(self.text) > self.window:
            self._begin(out)
        return out

    def encode_many(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts (null: none) and offsets into them; each distinct piece is merged once."""
        pieces: list[str] = []
        ends = [0]
        for text in texts:
            if text:
                parts = self.special.split(text) if self.special else [text]
                for i, part in enumerate(parts):
                    pieces += [part] if i % 2 else (self.far if _FAR.search(part) else self.near).findall(part)
            ends.append(len(pieces))
        coded = pa.array(pieces, pa.large_string()).dictionary_encode()
        distinct = coded.dictionary
        flat, place = self._distinct(distinct)
        index = np.asarray(coded.indices).astype(np.int64)
        counts = np.diff(place)[index]
        upto = np.concatenate([[0], np.cumsum(counts)])
        ids = flat[np.repeat(place[index] - upto[:-1], counts) + np.arange(upto[-1])]
        return ids, upto[ends]

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.frombuffer(pieces.buffers()[1], np.int64, len(pieces) + 1, pieces.offset * 8) if len(pieces) else np.zeros(1, np.int64)
        odd = [i for i in np.flatnonzero(np.diff(offsets) > self.window).tolist()]
        odd += [i for s in self.specials if (i := pieces.index(s).as_py()) >= 0]
        if not odd:
            data = np.frombuffer(pieces.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] else np.zeros(0, np.uint8)
            return merge_many(self.vocabulary, data, offsets - offsets[0])
        blank = np.ones(len(pieces), bool)
        blank[odd] = False
        usual = pc.if_else(pa.array(blank), pieces, pa.scalar("", pieces.type))
        flat, place = self._distinct(usual)
        parts = np.split(flat, place[1:-1])
        for i in odd:
            piece = pieces[i].as_py()
            special = self.vocabulary.special.get(piece)
            own = self._piece(piece) if special is None else _packed([special])
            parts[i] = np.frombuffer(own, np.int32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _piece(self, piece: str) -> bytes:
        """A whole piece; a long one goes through a window at a time. Ids of short ones are kept, so many at most."""
        if len(piece) <= self.window:
            ids = _packed(merge(self.vocabulary, piece.encode()))
            if len(piece) <= _MEMO_LENGTH:
                if len(self.memo) >= _MEMO:
                    self.memo.clear()
                self.memo[piece] = ids
            return ids
        out, rest = b"", b""
        for at in range(0, len(piece), self.window):
            ids, rest = self._settled(rest + piece[at : at + self.window].encode(), at + self.window >= len(piece))
            out += ids
        return out

    def _settled(self, data: bytes, last: bool) -> tuple[bytes, bytes]:
        ids = merge(self.vocabulary, data)
        if last:
            return _packed(ids), b""
        end = 0
        for n, i in enumerate(ids):
            size = len(self.vocabulary.bytes[i])
            if end + size > len(data) - self.vocabulary.lookahead:
                return _packed(ids[:n]), data[end:]
            end += size
        return _packed(ids), b""

    def _begin(self, out: bytearray) -> None:
        """The held text is longer than the window: emit what is settled of its first piece."""
        piece = self.far.match(self.text).group()
        if len(piece) > self.window:
            kinds = _KIND.match(piece[-1 if piece[0] == " " else 0]).groups()
            self.kind = ("letter", "number", "space", "other")[next(i for i, g in enumerate(kinds) if g is not None)]
            self.open = b""
            self._go_on(out, False)

    def _go_on(self, out: bytearray, last: bool) -> None:
        skip = not self.open and self.kind != "space" and self.text[:1] == " "
        n = _ON[self.kind].match(self.text, int(skip)).end()
        ended = last or n < len(self.text)
        if self.kind == "space" and not (last and n == len(self.text)):
            # The last white space before other text stands alone or goes to the next word.
            n = max(n - 1, 0)
        self.open, self.text = self.open + self.text[:n].encode(), self.text[n:]
        ids, self.open = self._settled(self.open, ended)
        out += ids
        if ended:
            self.kind = ""


class Decoder:
    """``feed`` ids in any portions, then ``finish``; text comes out as soon as its characters are whole."""

    def __init__(self, vocabulary: Vocabulary):
        most = max(vocabulary.bytes) + 1
        tokens = [vocabulary.bytes.get(i, b"") for i in range(most)]
        self.lens = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def raw(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of the ids, and where each begins, with the end."""
        lens = self.lens[ids]
        upto = np.concatenate([[0], np.cumsum(lens)])
        return self.data[np.repeat(self.starts[ids] - upto[:-1], lens) + np.arange(upto[-1])].tobytes(), upto

    def feed(self, ids) -> str:
        return self.state.decode(self.raw(np.asarray(ids, np.int64))[0])

    def finish(self) -> str:
        text = self.state.decode(b"", True)
        self.state.reset()
        return text

    def decode(self, ids) -> str:
        return self.decode_many(np.asarray(ids, np.int64), np.array([0, len(ids)]))[0]

    def decode_many(self, ids: np.ndarray, offsets: np.ndarray, portion: int = 1 << 18) -> list[str]:
        """Texts of runs of ids, fed in portions of bounded size."""
        out, parts, row = [], [], 0
        for at in range(0, max(1, len(ids)), portion):
            end = min(at + portion, len(ids))
            data, upto = self.raw(ids[at:end])
            while row < len(offsets) - 1:
                lo, hi = max(offsets[row], at) - at, min(offsets[row + 1], end) - at
                parts.append(self.state.decode(data[upto[lo] : upto[hi]]))
                if offsets[row + 1] > end:
                    break
                parts.append(self.finish())
                out.append("".join(parts))
                parts, row = [], row + 1
        return out


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(shared) -> Vocabulary:
    """One vocabulary for a worker, made from the broadcast file."""
    if shared.value not in _LOADED:
        _LOADED.clear()
        _LOADED[shared.value] = Vocabulary(shared.value)
    return _LOADED[shared.value]


def _share(spark: SparkSession, path: str):
    """The vocabulary file, a few megabytes whatever the data, goes to the executors as a broadcast."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def _encoded(encoder: Encoder, texts: pa.Array) -> pa.ListArray:
    """Ids of each text (null: none), as an Arrow list."""
    ids, ends = array("i"), [0]
    texts = texts.to_pylist()
    encoder.prime(texts)
    for text in texts:
        if text:
            ids += encoder.encode(text)
        ends.append(len(ids))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32)))


def _decoded(decoder: Decoder, lists: pa.ListArray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(lists.value_lengths(), 0)))])
    return pa.array(decoder.decode_many(np.asarray(lists.flatten()).astype(np.int64), ends), pa.string())


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", carry: list[str] | None = None) -> DataFrame:
    """The carried columns and ``ids``, array<int>."""
    return _coded(docs, path, text, ids, None, carry)


def round_trip(
    docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", carry: list[str] | None = None
) -> DataFrame:
    """``encode`` with ``decoded``, the text that the ids stand for; one pass, so one vocabulary in a worker."""
    return _coded(docs, path, text, ids, decoded, carry)


def _coded(docs: DataFrame, path: str, text: str, ids: str, decoded: str | None, carry: list[str] | None) -> DataFrame:
    shared = _share(docs.sparkSession, path)
    names = [c for c in (docs.columns if carry is None else carry) if c not in (ids, decoded)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared)
        encoder, decoder = Encoder(vocabulary), Decoder(vocabulary)
        for batch in words.slices(batches, "text", _ENCODE_BYTES):
            lists = _encoded(encoder, batch.column("text"))
            columns = [batch.column("row"), lists]
            if decoded is not None:
                columns.append(_decoded(decoder, lists))
            yield pa.RecordBatch.from_arrays(columns, names=["row", "made", "back"][: len(columns)])

    # The carried columns travel in a struct, so they may have any name.
    row = F.struct(*(docs[f"`{c}`"] for c in names)) if names else F.struct(F.lit(1).alias("none"))
    packed = docs.select(row.alias("row"), docs[f"`{text}`"].alias("text"))
    schema = StructType([*packed.select("row").schema.fields]).add("made", ArrayType(IntegerType()))
    back = [] if decoded is None else [F.col("back").alias(decoded)]
    made = packed.mapInArrow(run, schema if decoded is None else schema.add("back", StringType()))
    return made.select(*(F.col("row")[c].alias(c) for c in names), F.col("made").alias(ids), *back)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded", keep_ids: bool = False) -> DataFrame:
    """``rows`` with the text that the ids stand for, in their place or, with ``keep_ids``, beside them."""
    shared = _share(rows.sparkSession, path)
    names = [c for c in rows.columns if c != text and (keep_ids or c != ids)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(_vocabulary(shared))
        for whole in batches:
            for at in range(0, whole.num_rows, _DECODE_ROWS):
                batch = whole.slice(at, _DECODE_ROWS)
                columns = [*(batch.column(c) for c in names), _decoded(decoder, batch.column(ids))]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, text])

    return rows.select(*dict.fromkeys([*names, ids])).mapInArrow(run, rows.select(*names).schema.add(text, StringType()))
