"""SentencePiece encoding and decoding by suffix-array matching, for models of type BPE with byte fallback.

The distinct words of a batch are laid end to end and their suffixes sorted; a binary search for every piece gives the range of suffixes that
start with it, that is all its occurrences. Each occurrence is an edge; edges sorted by the position where they end are relaxed in order.

A BPE model does not ask for the path of the highest score, so the relaxation keeps the path that merging would have made. Merging never
crosses a boundary of its own result, so the result for a prefix that ends at a boundary is the result's first pieces, and pieces next to
each other in it are what merging makes of their concatenation. Conversely a sequence in which every two neighbours have that property is
the result. So each position keeps one edge: the one whose start is kept and whose piece agrees with the piece kept there.

Words are cut where a blank follows a non-blank: no piece of more than blanks has a blank after its first character, so no merge crosses a
cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nephogrid.llm._common import small_batches

BLANK = "▁"
#: Number of code points.
POINTS = 0x110000
WORDS = re.compile(" *[^ ]+| +")
#: About twice so many bytes of words and their ids are kept from one stretch to the next, and so many agreements of pieces.
CACHE_BYTES, CACHE_PAIRS = 32_000_000, 1_000_000
#: Texts are taken in stretches of about so many characters, longer ones in parts, and their new words in runs of so many, which bounds the
#: suffix array; a word longer than a run is relaxed window by window.
STRETCH_CHARS, RUN_CHARS = 1_000_000, 200_000
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


class Pieces:
    """The vocabulary of a model."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)  # read for its vocabulary only
        n = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        is_byte = [model.is_byte(i) for i in range(n)]
        self.id = {p: i for i, p in enumerate(self.text) if not special[i] and not is_byte[i]}
        self.score = [model.get_score(i) for i in range(n)]
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.text) if is_byte[i]}
        self.unknown = model.unk_id()
        if len(self.byte) not in (0, 256) or any(BLANK in p[1:] and p.strip(BLANK) for p in self.id):
            raise ValueError("not a BPE model with byte fallback, or one with blanks inside pieces")
        self.longest = max(map(len, self.id))
        # what an id adds to a decoded text; bytes join to characters afterwards
        self.bytes_of = [bytes([int(p[3:5], 16)]) if is_byte[i] else b"" if special[i] else p.replace(BLANK, " ").encode("utf-8") for i, p in enumerate(self.text)]
        # a piece that merging its own characters does not make is never in a result
        order = sorted((p for p in self.id if self.merge(list(p)) == [p]), key=len)
        self.points = np.full((len(order), self.longest), POINTS, np.int32)  # POINTS: past the piece's end
        for i, p in enumerate(order):
            self.points[i, : len(p)] = np.frombuffer(p.encode("utf-32-le"), np.uint32)
        self.ended = self.points == POINTS
        self.key_ids = np.array([self.id[p] for p in order])
        self.lengths = np.array([len(p) for p in order])
        self.pairs = _Agreements(self)

    def merge(self, symbols: list[str]) -> list[str]:
        """Join the adjacent two whose concatenation has the highest score, the leftmost of equals, until none is a piece."""
        symbols = list(symbols)
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                k = self.id.get(symbols[i] + symbols[i + 1])
                if k is not None and (best is None or self.score[k] > best):
                    best, at = self.score[k], i
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def agrees(self, left: int, right: int) -> bool:
        """Whether merging the concatenation of two pieces gives these two."""
        a, b = self.text[left], self.text[right]
        return self.merge(list(a + b)) == [a, b]


class WordIds:
    """Word -> its ids as bytes, in two generations: when the young one is full it becomes the old one, whose words come back as they are met."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.bytes = 0

    def missing(self, words: set[str]) -> set[str]:
        """The words that have to be encoded; the others are young now."""
        if self.bytes > CACHE_BYTES:
            self.young, self.old, self.bytes = {}, self.young, 0
        away = words.difference(self.young)
        back = [w for w in away if w in self.old]
        self.learn(back, [self.old[w] for w in back])
        return away.difference(back)

    def learn(self, words: list[str], ids: list[bytes]) -> None:
        self.young.update(zip(words, ids, strict=True))
        self.bytes += sum(map(len, ids)) + 4 * sum(map(len, words)) + 180 * len(words)


@lru_cache(maxsize=1)
def _pieces(path: str) -> tuple[Pieces, WordIds]:
    """A model's vocabulary and the words encoded so far, kept as long as the Python worker lives; both are bounded."""
    return Pieces(path), WordIds()


def suffix_array(codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all suffixes in order of their first ``width`` codes up to an end mark (0), and those codes as byte strings.

    ``codes`` are big-endian numbers of 1, 2 or 4 bytes, so bytes sort as codes do.
    """
    padded = np.zeros(len(codes) + width, codes.dtype)
    padded[: len(codes)] = codes
    views = np.lib.stride_tricks.sliding_window_view(padded, width)[: len(codes)].copy()
    ended = views == 0
    np.logical_or.accumulate(ended, axis=1, out=ended)
    views[ended] = 0
    columns = np.ascontiguousarray(views).view(np.uint8).reshape(len(codes), -1)
    whole = -(-columns.shape[1] // 8) * 8
    if whole != columns.shape[1]:
        columns = np.pad(columns, ((0, 0), (0, whole - columns.shape[1])))
    numbers = columns.view(">u8").astype(np.uint64)  # eight bytes at a time
    order = np.lexsort(numbers.T[::-1])
    return order, columns[order].view(f"S{whole}").ravel()


def occurrences(words: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, piece) of every occurrence of a piece in the words laid end to end, each followed by one end mark."""
    points = np.frombuffer("\x00".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    # Characters by rank from 1, in the fewest bytes that leave room for a code above the last.
    rank = np.zeros(POINTS + 1, np.int32)
    rank[points] = 1
    n_chars = int(rank.sum())
    rank[rank > 0] = np.arange(1, n_chars + 1)
    size = 1 if n_chars < 254 else 2 if n_chars < 65_000 else 4
    codes = np.zeros(len(points) + 1, f">u{size}")
    codes[:-1] = rank[points]
    codes[ends] = 0
    order, suffixes = suffix_array(codes, pieces.longest)
    # Only pieces of the text's own characters can occur.
    letters = rank[pieces.points]
    own = ((letters > 0) | pieces.ended).all(axis=1)
    lengths, ids = pieces.lengths[own], pieces.key_ids[own]
    keys = np.zeros((len(lengths), suffixes.dtype.itemsize // size), f">u{size}")
    keys[:, : pieces.longest] = letters[own]
    low = np.searchsorted(suffixes, keys.view(suffixes.dtype).ravel(), "left")
    keys[np.arange(len(keys)), lengths - 1] += 1  # the first that no longer starts with the piece
    n = np.searchsorted(suffixes, keys.view(suffixes.dtype).ravel(), "left") - low
    at = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else np.empty(0, np.int64)
    start = order[at].astype(np.int32)
    return start, start + np.repeat(lengths.astype(np.int32), n), np.repeat(ids.astype(np.int32), n)


class _Agreements:
    """Which pairs of pieces merging leaves as they are, looked up for whole arrays; pairs not seen before are tried once."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.n = pieces, len(pieces.text)
        self.keys, self.ok = np.empty(0, np.int64), np.empty(0, bool)
        # a table that holds for each slot the pair asked for last
        self.slot_key, self.slot_ok = np.full(1 << 20, -1, np.int64), np.zeros(1 << 20, bool)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        asked = left * self.n + right
        slot = (asked * 0x9E3779B1) >> 20 & ((1 << 20) - 1)
        out = self.slot_ok[slot]
        miss = np.flatnonzero(self.slot_key[slot] != asked)
        if len(miss):
            out[miss] = self._look_up(asked[miss])
            self.slot_key[slot[miss]], self.slot_ok[slot[miss]] = asked[miss], out[miss]
        return out

    def _look_up(self, asked: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, asked), max(0, len(self.keys) - 1))
        new = np.unique(asked[self.keys[at] != asked] if len(self.keys) else asked)
        if len(new):
            if len(self.keys) > CACHE_PAIRS:
                self.keys, self.ok, new = np.empty(0, np.int64), np.empty(0, bool), np.unique(asked)
            tried = [self.pieces.agrees(k // self.n, k % self.n) for k in new.tolist()]
            keys, ok = np.concatenate([self.keys, new]), np.concatenate([self.ok, np.array(tried, bool)])
            order = np.argsort(keys, kind="stable")
            self.keys, self.ok = keys[order], ok[order]
            at = np.searchsorted(self.keys, asked)
        return self.ok[at]


NONE, BEGIN, STRAY = -3, -2, -1


def encode_words(words: list[str], pieces: Pieces) -> list[bytes]:
    """Ids (int32) of each word; characters that are no piece become their bytes, or the unknown id.

    All words are relaxed together, one position in the word after the other.
    """
    start, end, ids = occurrences(words, pieces)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    base = np.cumsum(lengths + 1) - lengths - 1
    # Edges in order of the position in their word where they end: small numbers, which a stable sort takes by radix.
    within = np.arange(int(lengths.sum()) + len(words)) - np.repeat(base, lengths + 1)
    step = within[end]
    order = np.argsort(step.astype(np.uint16) if len(step) and step.max() < 1 << 16 else step, kind="stable")
    start, end, ids = start[order], end[order], ids[order]
    cuts = np.searchsorted(step[order], np.arange(1, lengths.max() + 2))
    # the piece kept at each position (between characters), and where it starts
    kept = np.full(int(lengths.sum()) + len(words), NONE, np.int64)
    origin = np.zeros(len(kept), np.int64)
    kept[base] = BEGIN
    text = "\x00".join(words)
    stray_chars = {c for c in set(text) if c not in pieces.id}
    stray_at = np.array(sorted(m.end() for c in stray_chars for m in re.finditer(re.escape(c), text)), np.int64) if stray_chars - {"\x00"} or "\x00" in "".join(words) else np.empty(0, np.int64)
    stray_at = stray_at[~np.isin(stray_at, base)]  # the marks between words end where a word begins
    stray_step = stray_at - base[np.searchsorted(base, stray_at - 1, "right") - 1] if len(stray_at) else stray_at
    by_step = np.argsort(stray_step, kind="stable")
    stray_at, stray_step = stray_at[by_step], stray_step[by_step]
    stray_cuts = np.searchsorted(stray_step, np.arange(1, lengths.max() + 2))
    for p in range(1, int(lengths.max()) + 1):
        a, z = cuts[p - 1], cuts[p]
        if z > a:
            left, stop, piece = kept[start[a:z]], end[a:z], ids[a:z]
            ok = left >= BEGIN
            inner = np.flatnonzero(left >= 0)
            if len(inner):
                ok[inner] = pieces.pairs.of(left[inner], piece[inner].astype(np.int64))
            hit = np.flatnonzero(ok)
            kept[stop[hit]], origin[stop[hit]] = piece[hit], start[a:z][hit]
        a, z = stray_cuts[p - 1], stray_cuts[p]
        if z > a:
            at = stray_at[a:z]
            at = at[(kept[at] == NONE) & (kept[at - 1] != NONE)]
            kept[at], origin[at] = STRAY, at - 1
    # Walk back from the ends of all words at once; on_path marks the positions where a kept piece ends.
    on_path = np.zeros(len(kept), bool)
    now = (base + lengths)[lengths > 0]
    while len(now):
        on_path[now] = True
        now = origin[now]
        now = now[kept[now] != BEGIN]
    at = np.flatnonzero(on_path)
    flat = kept[at].astype(np.int32)
    bounds = np.searchsorted(at, np.concatenate([base, [len(kept)]]), "right")
    blob, out = flat.tobytes(), []
    strays = set((np.searchsorted(base, at[flat == STRAY], "left") - 1).tolist())
    for i, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if i in strays:
            got: list[int] = []
            for k, stop in zip(flat[a:z].tolist(), (at[a:z] - base[i]).tolist(), strict=True):
                raw = words[i][stop - 1].encode("utf-8", "surrogatepass")
                got += [k] if k >= 0 else [pieces.byte[x] for x in raw] if pieces.byte else [pieces.unknown]
            out.append(np.array(got, np.int32).tobytes())
        else:
            out.append(blob[4 * a : 4 * z])
    return out


def encode_long(word: str, pieces: Pieces) -> bytes:
    """Ids (int32) of one word of any length, as ``encode_words`` gives them.

    A position depends on those at most the longest piece before it, so windows are matched and relaxed one after the other; what is kept of
    the whole word is eight bytes a character.
    """
    n, reach = len(word), pieces.longest
    kept, origin = np.full(n + 1, NONE, np.int32), np.zeros(n + 1, np.int32)
    kept[0] = BEGIN
    agree: dict[tuple[int, int], bool] = {}
    for a in range(0, n, RUN_CHARS):
        first, z = max(0, a - reach), min(n, a + RUN_CHARS)
        start, end, ids = occurrences([word[first:z]], pieces)
        here = end > a - first  # an edge belongs to the window it ends in
        start, end, ids = start[here] + first, end[here] + first, ids[here]
        order = np.argsort(end, kind="stable")
        cuts = np.searchsorted(end[order], np.arange(a + 1, z + 2)).tolist()
        start, ids = start[order].tolist(), ids[order].tolist()
        state, back = kept[first : z + 1].tolist(), origin[first : z + 1].tolist()
        for p in range(a + 1, z + 1):
            for e in range(cuts[p - a - 1], cuts[p - a]):
                left, piece = state[start[e] - first], ids[e]
                if left >= 0:
                    if (left, piece) not in agree:
                        if len(agree) > CACHE_PAIRS // 10:
                            agree.clear()
                        agree[left, piece] = pieces.agrees(left, piece)
                    fits = agree[left, piece]
                else:
                    fits = left in (BEGIN, STRAY)
                if fits:
                    state[p - first], back[p - first] = piece, start[e]
            if state[p - first] == NONE and word[p - 1] not in pieces.id and state[p - 1 - first] != NONE:
                state[p - first], back[p - first] = STRAY, p - 1
        kept[first : z + 1], origin[first : z + 1] = state, back
    on_path, at = np.zeros(n + 1, bool), n
    while at:
        on_path[at] = True
        at = int(origin[at])
    ends = np.flatnonzero(on_path)
    flat = kept[ends]
    if not (flat == STRAY).any():
        return flat.tobytes()
    got: list[int] = []
    for k, stop in zip(flat.tolist(), ends.tolist(), strict=True):
        got += [k] if k >= 0 else [pieces.byte[x] for x in word[stop - 1].encode("utf-8", "surrogatepass")] if pieces.byte else [pieces.unknown]
    return np.array(got, np.int32).tobytes()


def _parts(text: str | None) -> Iterator[str]:
    """A text with the blank that encoding puts in front, in parts of about STRETCH_CHARS characters, cut where a blank follows a non-blank."""
    t = " " + text.replace(BLANK, " ") if text else ""
    at = 0
    while len(t) - at > STRETCH_CHARS:
        cut = t.find(" ", at + STRETCH_CHARS)
        while cut > 0 and t[cut - 1] == " ":
            cut = t.find(" ", cut + 1)
        if cut < 0:
            break
        yield t[at:cut]
        at = cut
    if at < len(t):
        yield t[at:]


def _cut(part: str) -> list[str]:
    """Keys of the words of a part: the word itself if one blank stands before it, else the word with all its blanks."""
    if part[-1] != " " and "  " not in part:
        return part[1:].split(" ")
    return [w[1:] if w[1:2] not in ("", " ") and w[0] == " " else w for w in WORDS.findall(part)]


def _spelled(key: str) -> str:
    return key.replace(" ", BLANK) if key[0] == " " else BLANK + key


def encode_texts(texts: list[str | None], pieces: Pieces, known: WordIds) -> list[np.ndarray]:
    """Ids of each text; ``known`` keeps words from call to call."""
    out: list[np.ndarray] = []
    for text in texts:
        if len(text or "") > STRETCH_CHARS:
            got = [_encode_parts([p], pieces, known)[0] for p in _parts(text)]
            out.append(np.concatenate(got))
        else:
            out.append(None)
    short = [i for i, x in enumerate(out) if x is None]
    whole = [next(_parts(texts[i]), "") for i in short]
    for i, ids in zip(short, _encode_parts(whole, pieces, known), strict=True):
        out[i] = ids
    return out


def _encode_parts(parts: list[str], pieces: Pieces, known: WordIds) -> list[np.ndarray]:
    """Ids of each part."""
    cut = [_cut(p) if p else [] for p in parts]
    fresh = sorted(known.missing(set().union(*cut)), key=len)  # like lengths together
    at = 0
    while at < len(fresh):  # runs of bounded length
        if len(fresh[at]) > RUN_CHARS:
            known.young[fresh[at]] = encode_long(_spelled(fresh[at]), pieces)
            at += 1
            continue
        size, stop = 0, at
        while stop < len(fresh) and (stop == at or size + len(fresh[stop]) < RUN_CHARS):
            size += len(fresh[stop]) + 2
            stop += 1
        known.learn(fresh[at:stop], encode_words([_spelled(w) for w in fresh[at:stop]], pieces))
        at = stop
    out = [np.frombuffer(b"".join(map(known.young.__getitem__, words)), np.int32) for words in cut]
    for w in reversed(fresh):
        if len(w) <= 40:
            break
        del known.young[w]  # its bytes stay counted, which only empties the cache sooner
    return out


def decode_ids(ids: np.ndarray | list[int] | None, pieces: Pieces) -> str:
    """The text of ids: pieces joined, blanks restored, byte pieces joined to characters, the blank that encoding puts in front taken off.

    Bytes that are no characters become U+FFFD; unknown and control ids add nothing; ids outside the vocabulary raise.
    """
    if ids is None or not len(ids):
        return ""
    text = b"".join(map(pieces.bytes_of.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _stretches(texts: pd.Series) -> Iterator[tuple[int, int]]:
    """Slices of about STRETCH_CHARS characters."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= STRETCH_CHARS:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _shipped(spark: SparkSession, path: str) -> str:
    """Send the model file to the executors; gives its name there."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if name not in {p.rsplit("/", 1)[-1] for p in spark.sparkContext.listFiles}:
        spark.sparkContext.addFile(path)
    return name


def encode(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) for every row of (doc_id, text); ``round_trip`` tells whether decoding the ids gives the text back.

    Null and empty texts have no ids and round-trip to the empty text. Texts that hold U+2581, which the model uses for the blank, come back
    with blanks in its place. Repeated rows each come back; an empty table gives an empty result; other columns are ignored.
    """
    name = _shipped(docs.sparkSession, model)
    small_batches(docs.sparkSession)

    @F.pandas_udf("n_tokens long, ids array<int>, round_trip boolean")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pieces, known = _pieces(SparkFiles.get(name))
        for b in batches:
            for a, z in _stretches(b):
                texts = b.iloc[a:z].tolist()
                ids = encode_texts(texts, pieces, known)
                same = [decode_ids(x, pieces) == (t or "") for x, t in zip(ids, texts, strict=True)]
                yield pd.DataFrame({"n_tokens": pd.Series(map(len, ids), dtype="int64"), "ids": pd.Series(ids, dtype=object), "round_trip": pd.Series(same, dtype=bool)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), of(F.col("text").cast("string")).alias("got")).select("doc_id", "got.*")


def decode(encoded: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """(doc_id, text) for every row of (doc_id, ids); null and empty ids give the empty text."""
    name = _shipped(encoded.sparkSession, model)
    small_batches(encoded.sparkSession)

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces, _ = _pieces(SparkFiles.get(name))
        for b in batches:
            yield pd.Series([decode_ids(x, pieces) for x in b], dtype=object)

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), of(F.col("ids").cast("array<int>")).alias("text"))
