"""Packed trigram sets, MinHash base hashes, signatures and band keys."""

from __future__ import annotations

import zlib
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# Fixed values of the hash family  h_i(x) = ((i + 1) * x + 137 * i) mod (2^31 - 1).
MODULUS = 2_147_483_647
SHIFT = 137
# No residue reaches the modulus, so it marks the slots of a text without trigrams.
EMPTY_SLOT = MODULUS

# A code point fits 21 bits, three of them one 64-bit number.
BITS = 21
LOW = (1 << BITS) - 1

# Tokens worked on together: small enough for the processor cache.
TILE = 32_768

# Bytes of text worked on together, which bounds a task's memory whatever the size of its batches,
# and trigrams whose hashes are kept from one such piece of a batch to the next.
PIECE = 1 << 21
KNOWN = 1 << 20


def base_hashes(grams: Column) -> Column:
    """First eight hex digits of each trigram's MD5 as a number."""
    return F.transform(
        grams, lambda g: F.conv(F.substring(F.md5(g.cast("binary")), 1, 8), 16, 10).cast("bigint")
    )


def set_reader():
    """Function that turns a batch of texts into their sets of packed trigrams.

    Local functions travel to the executors by value, which need no copy of the package.
    """

    def read(batch):
        sets = []
        for raw in batch.cast(pa.large_binary()).to_pylist():
            text = (raw or b"").decode("utf-8", "replace").encode("utf-32-le")
            points = np.frombuffer(text, np.uint32).astype(np.int64)
            sets.append(np.unique(points[:-2] << 2 * BITS | points[1:-1] << BITS | points[2:]))
        return np.array([len(s) for s in sets], np.int64), np.concatenate(sets)

    return read


def piecewise(work):
    """Function that applies ``work`` to slices of a batch of at most ``PIECE`` bytes, a longer text alone."""
    limit = PIECE

    def whole(batch):
        sizes = pc.fill_null(pc.binary_length(batch), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        made, low = [], 0
        while low < len(batch):
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + limit, side="right")))
            made.append(work(batch.slice(low, high - low)))
            low = high
        return pa.concat_arrays(made) if made else work(batch)

    return whole


def gram_hasher():
    """Function that gives the MD5 base hash of each of some distinct packed trigrams.

    Hashes are kept between calls, up to ``KNOWN`` of them, so that a batch worked on in pieces hashes
    a trigram about as rarely as one worked on as a whole.
    """
    most, low, shift = KNOWN, LOW, BITS
    kept = [np.empty(0, np.int64), np.empty(0, np.int64)]

    def hashes(codes):
        known, bases = kept
        at = np.searchsorted(known, codes)
        there = at < len(known)
        there[there] = known[at[there]] == codes[there]
        new = codes[~there]
        words = (chr(c >> 2 * shift) + chr(c >> shift & low) + chr(c & low) for c in new.tolist())
        made = np.array([int.from_bytes(md5(word.encode()).digest()[:4], "big") for word in words], np.int64)
        result = np.empty(len(codes), np.int64)
        result[there] = bases[at[there]]
        result[~there] = made
        if len(known) + len(new) > most:
            kept[:] = codes, result
        elif len(new):
            kept[:] = np.insert(known, at[~there], new), np.insert(bases, at[~there], made)
        return result

    return hashes


def gram_codes(text: Column) -> Column:
    """Distinct trigrams of the lower-cased text as ascending numbers of three code points.

    The numbering is one-to-one, so sets of codes compare exactly like sets of
    trigrams.  Measured per core it is several times faster than the string form
    :func:`tillmark.functions.text.trigrams`, whose sets it equals.
    """
    read = set_reader()

    @piecewise
    def listed(batch):
        lengths, found = read(batch)
        offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found))

    @F.arrow_udf("array<bigint>")
    def codes(batch: pa.Array) -> pa.Array:
        return listed(batch)

    return codes(F.lower(text))


def gram_digest(text: Column) -> Column:
    """``size`` and ``digest`` of the trigram set: equal digests mean equal sets."""
    read = set_reader()

    @piecewise
    def digested(batch):
        lengths, found = read(batch)
        ends = np.cumsum(lengths)
        sums = [md5(found[e - n : e].tobytes()).hexdigest() for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
        return pa.StructArray.from_arrays([pa.array(lengths.astype(np.int32)), pa.array(sums, pa.string())], ["size", "digest"])

    @F.arrow_udf("struct<size:int,digest:string>")
    def digests(batch: pa.Array) -> pa.Array:
        return digested(batch)

    return digests(F.lower(text))


def gram_packed(text: Column) -> Column:
    """The trigram set as compressed bytes, a fraction of its text: the steps between its ascending codes, byte by byte.

    :func:`set_unpacker` gives the codes back.
    """
    read = set_reader()

    @piecewise
    def packed(batch):
        lengths, found = read(batch)
        ends = np.cumsum(lengths)
        steps = (np.diff(found[e - n : e], prepend=0) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True))
        return pa.array([zlib.compress(s.view(np.uint8).reshape(-1, 8).T.tobytes(), 1) for s in steps], pa.binary())

    @F.arrow_udf("binary")
    def packs(batch: pa.Array) -> pa.Array:
        return packed(batch)

    return packs(F.lower(text))


def set_unpacker():
    """Function that turns the bytes of :func:`gram_packed` into an array of codes."""

    def unpack(raw):
        planes = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(8, -1)
        return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())

    return unpack


def gram_totals(text: Column) -> Column:
    """``trigrams`` and ``hash_sum``: size of the trigram set and the sum of its base hashes."""
    read, hashes = set_reader(), gram_hasher()

    @piecewise
    def summed(batch):
        lengths, found = read(batch)
        codes, positions = np.unique(found, return_inverse=True)
        running = np.concatenate(([0], np.cumsum(hashes(codes)[positions])))
        ends = np.cumsum(lengths)
        sums = running[ends] - running[ends - lengths]
        return pa.StructArray.from_arrays([pa.array(lengths.astype(np.int32)), pa.array(sums)], ["trigrams", "hash_sum"])

    @F.arrow_udf("struct<trigrams:int,hash_sum:bigint>")
    def totals(batch: pa.Array) -> pa.Array:
        return summed(batch)

    return totals(F.lower(text))


def signature(text: Column, k: int = 400) -> Column:
    """``k`` minima of the hash family over the text's trigrams, as ``array<int>``.

    The trigrams of a piece of a batch form one flat vector in which each distinct one is
    hashed once.  Neighbouring members of the family differ by ``x + 137``, so each step is
    one addition and one conditional subtraction over 32-bit lanes instead of a
    64-bit division.
    """
    read, hashes = set_reader(), gram_hasher()

    @piecewise
    def signed(batch):
        lengths, found = read(batch)
        codes, positions = np.unique(found, return_inverse=True)
        tokens = (hashes(codes) % MODULUS).astype(np.uint32)[positions]
        result = np.full((len(lengths), k), EMPTY_SLOT, dtype=np.int32)
        rows = np.flatnonzero(lengths)
        ends = np.cumsum(lengths[rows])
        starts = ends - lengths[rows]
        low = 0
        while low < len(rows):
            high = max(low + 1, int(np.searchsorted(ends, starts[low] + TILE, side="right")))
            current = tokens[starts[low] : ends[high - 1]]
            step = ((current.astype(np.uint64) + SHIFT) % MODULUS).astype(np.uint32)
            cuts = starts[low:high] - starts[low]
            for i in range(k):
                result[rows[low:high], i] = np.minimum.reduceat(current, cuts)
                current = current + step
                # Below the modulus the subtraction wraps round to something larger.
                current = np.minimum(current, current - np.uint32(MODULUS))
            low = high
        offsets = np.arange(0, (len(lengths) + 1) * k, k, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(result.ravel()))

    @F.arrow_udf("array<int>")
    def minima(batch: pa.Array) -> pa.Array:
        return signed(batch)

    return minima(F.lower(text))


def slot_agreement(a: Column, b: Column) -> Column:
    """Share of equal positions of two signatures."""
    equal = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(equal, F.lit(0), lambda acc, v: acc + v) / F.size(a)


def band_keys(sig: Column, bands: int = 20, rows: int = 20) -> Column:
    """MD5 of each band's slots, printed the way a tuple of numbers prints."""
    closing = ",)" if rows == 1 else ")"

    def key(band: int) -> Column:
        slots = F.transform(
            F.slice(sig, band * rows + 1, rows),
            lambda v: F.when(v == EMPTY_SLOT, "inf").otherwise(v.cast("string")),
        )
        return F.md5(F.concat(F.lit("("), F.array_join(slots, ", "), F.lit(closing)).cast("binary"))

    return F.array(*[key(band) for band in range(bands)])
