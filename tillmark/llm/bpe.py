"""BPE by speculation and verification.

Each word is first cut greedily into its longest known tokens. A cut is the BPE encoding if
and only if every adjacent pair of tokens is compatible: merging the text of the two alone
gives just these two tokens. All pairs of a batch are tested at once in numpy; only the
words with an incompatible pair go through exact merging.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain, pairwise

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from tillmark.llm.common import Batches, map_batches, sha, table

VOCABULARY = "word_bpe_49k.json"
END = "</w>"
NEVER = np.int64(1) << 40
#: Words ``'s|'t|...`` as in the vocabulary file, with white space as the library sees it.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
#: Below this code point no character composes with another, and lower case is context-free.
_PLAIN = "ɐ"
#: ASCII marks that make one word where they stand together; the apostrophe may open a word.
_MARKS = b".,;:!?"
#: What stands against preparing a text as a whole.
_BEYOND = re.compile("[\u0250-\U0010ffff\u0130]|<\\|")
#: A letter before a mark that ends a stretch: a blank between them changes no word.
_BREAK = re.compile("([a-z\u00df-\u00f6\u00f8-\u024f])(?=[.,;:!?](?:[ \t\n\r\x0b\x0c]|$))")
_SEGMENT = 1 << 22
_GENERATION = 500_000
_SHORT = 64
_ROWS = 8192
_NONE = 1 << 40


def vocabulary(name: str = VOCABULARY) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_names() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    later = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(later)) for b in range(256)]


def segments(raw: bytes, size: int = _SEGMENT) -> Iterator[bytes]:
    """A long text in parts that end at white space, so that its words need not be held at once."""
    at = 0
    while len(raw) - at > size:
        blank = re.compile(rb"[\x20\x09-\x0D]").search(raw, at + size)
        if blank is None:
            break
        yield raw[at : blank.end()]
        at = blank.end()
    yield raw[at:]


def prepared(text: str) -> bytes:
    """UTF-8 of a text with the same words but fewer different stretches: in lower case, marks set apart.

    Only where lower case is context-free and no special token can occur.
    """
    if "<|" not in text if text.isascii() else not _BEYOND.search(text):
        text = _BREAK.sub(r"\1 ", text.lower())
    return text.encode("utf-8", "surrogatepass")


class WordBpe:
    """Encoder and decoder for a vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        model = data["model"]
        self.library = Tokenizer.from_file(path)
        self.special = {t["content"].encode(): t["id"] for t in data["added_tokens"]}
        self.split_special = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")")
        size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.names = [""] * size
        to_byte = self.to_byte = {c: b for b, c in enumerate(_byte_names())}
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for token, i in model["vocab"].items():
            self.names[i] = token
            last = token.endswith(END)
            (self.final if last else self.inner)[bytes(to_byte[c] for c in token.removesuffix(END))] = i
        for token, i in self.special.items():
            self.names[i] = token.decode()
        self.digits = [str(i) for i in range(size)]
        # How each token is formed: its two parts and the rank of the merge, -1 for single bytes.
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.formed = np.full(size, -1, np.int64)
        self.rank_of: dict[int, int] = {}  # by first token * size + second
        self.made: list[int] = []
        ids = model["vocab"]
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            made = ids[a + b]
            self.rank_of[ids[a] * size + ids[b]] = rank
            self.made.append(made)
            self.left[made], self.right[made], self.formed[made] = ids[a], ids[b], rank
        codes = np.array(list(self.rank_of), np.int64)
        order = np.argsort(codes)
        self.codes, self.code_ranks = codes[order], np.array(list(self.rank_of.values()), np.int64)[order]
        self.size = size
        self.made_by = np.array(self.made, np.int64)
        # Ids of single bytes, inside a word and as its last one.
        self.first, self.first_last = (np.array([t.get(bytes([b]), 0) for b in range(256)], np.int64) for t in (self.inner, self.final))
        self.reach: dict[bytes, int] = {}  # by the first four or five bytes: length of the longest token
        for token in self.inner:
            for begin in {token[:4], token[:5]}:
                self.reach[begin] = max(len(token), self.reach.get(begin, 0))
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.packed = [self.kind(i).tobytes() for i in range(size)]
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    # Words ------------------------------------------------------------------

    def pieces(self, chunk: bytes) -> list[bytes]:
        """Normalised words of a stretch without white space that holds no special token."""
        if chunk.isalpha():  # ASCII letters only
            return [chunk.lower()]
        if (core := chunk.rstrip(_MARKS)).isalpha():  # and marks after them
            return [core.lower(), chunk[len(core) :]]
        text = chunk.decode("utf-8", "replace")
        if max(text) < _PLAIN:
            text = text.lower()
            return [text.encode("utf-8")] if text.isalpha() else [p.encode("utf-8") for p in _PIECES.findall(text)]
        text = self.library.normalizer.normalize_str(text)  # its edition of Unicode decides
        found = self.library.pre_tokenizer.pre_tokenize_str(text)
        return [bytes(map(self.to_byte.__getitem__, p)) for p, _ in found]

    def greedy(self, piece: bytes) -> list[int]:
        """Longest-match tokens of a word; the last carries the word's end."""
        out, at, n = [], 0, len(piece)
        inner, final, reach = self.inner.get, self.final.get, self.reach.get
        while (last := final(piece[at:])) is None:
            far = reach(piece[at : at + 5]) or (4 if piece[at : at + 4] in self.reach else 3)
            for stop in range(min(n - 1, at + far), at, -1):
                if (token := inner(piece[at:stop])) is not None:
                    out.append(token)
                    at = stop
                    break
        out.append(last)
        return out

    def merged(self, piece: bytes) -> list[int]:
        """Exact encoding: the merge of lowest rank, leftmost first, until none applies."""
        row = [self.inner[piece[i : i + 1]] for i in range(len(piece) - 1)] + [self.final[piece[-1:]]]
        if len(row) > _SHORT:
            return self._merged_long(row)
        size, rank_of, made = self.size, self.rank_of, self.made
        ranks = [rank_of.get(a * size + b, _NONE) for a, b in pairwise(row)]
        while ranks and (low := min(ranks)) != _NONE:
            i = ranks.index(low)
            row[i : i + 2] = [made[low]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank_of.get(row[i - 1] * size + row[i], _NONE)
            if i < len(ranks):
                ranks[i] = rank_of.get(row[i] * size + row[i + 1], _NONE)
        return row

    def _merged_long(self, row: list[int]) -> list[int]:
        """The same for a long word, in n log n steps: open merges in a heap, tokens in a linked list."""
        n, size, rank_of = len(row), self.size, self.rank_of
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if (rank := rank_of.get(row[i] * size + row[j])) is not None:
                heapq.heappush(heap, (rank, i, row[i], row[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if row[i] == a else n
            if j >= n or row[j] != b:
                continue
            row[i], row[j] = self.made[rank], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [x for x in row if x >= 0]

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a * self.size + b
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.code_ranks[at], NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens stays a pair when its text is merged.

        Merges run by rank, so the later of the merges that formed the two tokens has the
        higher rank. Undoing them from the last to the first shows what stood on either side
        of the border at any time: had those two a merge that came before the one undone,
        it would have crossed the border. Merges of one rank run from left to right.
        """
        good = np.ones(len(a), bool)
        active, x, y = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        until = np.full(len(a), 4 * NEVER)
        while len(active):
            crossed = 2 * self._rank(x, y) < np.where(until > 2 * NEVER, 2 * NEVER, until)
            good[active[crossed]] = False
            by_x, by_y = self.formed[x], self.formed[y]
            on = ~crossed & ((by_x >= 0) | (by_y >= 0))
            active, x, y, by_x, by_y = active[on], x[on], y[on], by_x[on], by_y[on]
            undo_y = by_y >= by_x
            until = np.where(undo_y, 2 * by_y + 1, 2 * by_x)
            x, y = np.where(undo_y, x, self.right[x]), np.where(undo_y, self.left[y], y)
        return good

    def _merged_together(self, found: list[bytes]) -> list[bytes]:
        """Packed ids of ``merged`` for many words at once.

        Words of one length are rows of a matrix. Each round does in every row what ``merged`` does:
        the leftmost merge of lowest rank; a row without one leaves. So all rows left are equally long.
        """
        out: list[bytes] = [b""] * len(found)
        by_length: dict[int, list[int]] = defaultdict(list)
        for i, piece in enumerate(found):
            by_length[len(piece)].append(i)
        for n, members in by_length.items():
            if n > _SHORT:
                for i in members:
                    out[i] = b"".join(map(self.packed.__getitem__, self.merged(found[i])))
                continue
            for at in range(0, len(members), _ROWS):
                part = np.array(members[at : at + _ROWS])
                raw = np.frombuffer(b"".join([found[i] for i in part]), np.uint8).reshape(-1, n)
                tokens = self.first[raw]
                tokens[:, -1] = self.first_last[raw[:, -1]]
                ranks = self._rank(tokens[:, :-1].ravel(), tokens[:, 1:].ravel()).reshape(-1, n - 1)
                while len(part):
                    width = tokens.shape[1]
                    if width > 1:
                        best = ranks.argmin(axis=1)
                        low = ranks[np.arange(len(part)), best]
                        on = low < NEVER
                    else:
                        on = np.zeros(len(part), bool)
                    blob, size = tokens[~on].astype(self.kind).tobytes(), width * self.kind().itemsize
                    for k, i in enumerate(part[~on].tolist()):
                        out[i] = blob[k * size : (k + 1) * size]
                    part, tokens = part[on], tokens[on]
                    if not len(part):
                        break
                    ranks, best, low = ranks[on], best[on], low[on]
                    rows, places = np.arange(len(part)), np.arange(width - 1)
                    tokens[rows, best] = self.made_by[low]
                    tokens = np.take_along_axis(tokens, places + (places > best[:, None]), 1)
                    ranks = np.take_along_axis(ranks, places[:-1] + (places[:-1] >= best[:, None]), 1)
                    left, right = np.flatnonzero(best > 0), np.flatnonzero(best < width - 2)
                    ranks[left, best[left] - 1] = self._rank(tokens[left, best[left] - 1], tokens[left, best[left]])
                    ranks[right, best[right]] = self._rank(tokens[right, best[right]], tokens[right, best[right] + 1])
        return out

    def encode_packed(self, found: list[bytes]) -> list[bytes]:
        """Packed token ids of normalised words."""
        rows = [self.greedy(p) for p in found]
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        ends = np.cumsum(lengths)
        flat = np.fromiter(chain.from_iterable(rows), np.int64, int(lengths.sum()))
        inside = np.ones(len(flat), bool)
        inside[ends - 1] = False  # no pair reaches into the next word
        at = np.flatnonzero(inside)
        pairs, back = np.unique(flat[at] * self.size + flat[at + 1], return_inverse=True)
        wrong = ~self.compatible(pairs // self.size, pairs % self.size)[back]
        blob, size = flat.astype(self.kind).tobytes(), self.kind().itemsize
        stops = (ends * size).tolist()
        codes = [blob[a:b] for a, b in zip([0, *stops], stops, strict=False)]
        failing = np.unique(np.repeat(np.arange(len(rows)), lengths)[at[wrong]]).tolist()
        for i, code in zip(failing, self._merged_together([found[i] for i in failing]), strict=True):
            codes[i] = code
        return codes

    def encode_words(self, found: list[bytes]) -> list[list[int]]:
        """Token ids of normalised words."""
        return [np.frombuffer(code, self.kind).tolist() for code in self.encode_packed(found)]

    # Texts ------------------------------------------------------------------

    def _learn(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        """Encodings of stretches without white space, as packed ids."""
        plain = [c for c in chunks if c.isalpha() and c.islower()]  # ASCII words as they stand
        known = dict(zip(plain, self.encode_packed(plain), strict=True)) if plain else {}
        parts: dict[bytes, list[bytes]] = {}
        needed: set[bytes] = set()
        for chunk in chunks.difference(known):
            row: list[bytes] = []
            for part in self.split_special.split(chunk) if b"<|" in chunk else (chunk,):
                if part in self.special:
                    row.append(part)
                elif part:
                    row += self.pieces(part)
            parts[chunk] = row
            needed.update(row)
        packed = self.packed.__getitem__
        made = dict(known)
        known.update({i: packed(n) for i, n in self.special.items()})
        young, old = self.young, self.old
        for p in needed:
            if p not in known and (code := young.get(p) or old.get(p)):
                known[p] = code
        fresh = [p for p in needed if p not in known]
        if fresh:
            known.update(zip(fresh, self.encode_packed(fresh), strict=True))
        made.update({c: known[r[0]] if len(r) == 1 else b"".join(map(known.__getitem__, r)) for c, r in parts.items()})
        return made

    def _look_up(self, lists: list[list[bytes]]) -> list[bytes]:
        """Packed ids of lists of stretches. Two generations of known ones bound the memory."""
        young, old = self.young, self.old
        fresh: set[bytes] = set()
        every: list[list[bytes | None]] = []
        gaps: list[tuple[list[bytes], list[bytes | None], list[int]]] = []
        for found in lists:
            codes = list(map(young.get, found))
            every.append(codes)
            if None in codes:
                at = [i for i, code in enumerate(codes) if code is None]
                gaps.append((found, codes, at))
                for i in at:
                    if (code := old.get(w := found[i])) is None:
                        fresh.add(w)
                    else:
                        young[w] = code
        if fresh:
            young.update(self._learn(fresh))
        for found, codes, at in gaps:
            for i in at:
                codes[i] = young[found[i]]
        out = [b"".join(codes) for codes in every]
        if len(young) > _GENERATION:
            self.old, self.young = young, {}
        return out

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text; no text counts as empty. Short texts are looked up together, long ones in parts."""
        group: list[list[bytes]] = []
        held = 0

        def done() -> Iterator[np.ndarray]:
            for code in self._look_up(group):
                yield np.frombuffer(code, self.kind)

        for text in texts:
            raw = prepared(text or "")
            if held + len(raw) > _SEGMENT and group:
                yield from done()
                group, held = [], 0
            if len(raw) > _SEGMENT:
                parts = [self._look_up([part.split()])[0] for part in segments(raw)]
                yield np.frombuffer(b"".join(parts), self.kind)
            else:
                group.append(raw.split())
                held += len(raw)
        yield from done()

    def ids_text(self, ids: np.ndarray) -> str:
        return " ".join(map(self.digits.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        """Token names joined by a space: the file names no decoder."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


@cache
def encoder(path: str) -> WordBpe:
    """One encoder a process; it lives as long as the worker."""
    return WordBpe(path)


def tokenise(docs: DataFrame, path: str, carry: str = "doc_id", text: str = "text") -> DataFrame:
    """``carry``, token count and the digests of ids and decoded text of every row, without shuffle.

    Whole texts, whatever their length. NULL and empty texts have no tokens and decode to ''.
    Equal rows stay as many as they are; an empty table gives no rows. Special tokens written
    out in a text are encoded as such, as the tokenizers library does.
    """
    slim = docs.select(F.col(f"`{carry}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = slim.schema["key"].dataType.simpleString()

    def work(batches: Batches) -> Iterator[dict]:
        coder = encoder(path)
        for batch in batches:
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for ids in coder.encode(batch.column("text").to_pylist()):
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(sha(coder.ids_text(ids)))
                out["decoded_sha256"].append(sha(coder.decode(ids)))
            yield {"key": batch.column("key")} | out

    made = map_batches(slim, work, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return made.withColumnRenamed("key", carry)


def op6_word_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return tokenise(table(spark, folder, "documents"), vocabulary())
