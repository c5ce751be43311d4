"""Spelling variants: words one edit apart, found by scanning sorted word lists.

Two words one edit apart agree before and after the edit. Cut the longer one anywhere: what lies
on one side of the cut is the same in both. So words meet in groups that share one half, in both
classes of length that a word can be compared in; a group too large for one task is cut again.
Inside a group the sorted list is scanned for each word: rows of the edit matrix, a band of three
cells, stay valid for the prefix that the next word shares, and a prefix that already costs more
than one edit is passed over with all words that have it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillmark.llm.common import Batches, map_batches, table
from tillmark.operators.skew import join_unique
from tillmark.staging import stage

# Letters are A-Z, a-z and U+00C0 to U+00FF; in Latin-1 a code point is a byte.
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 0xC0 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_FLUSH = 1 << 20
FAR = 2


# Words ------------------------------------------------------------------------


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters in Latin-1, A-Z in lower case."""
    return (text or "").encode("latin-1", "replace").translate(_LETTERS).split()


def slipped(word: bytes, start: int, every: int) -> bytes:
    """The word, less one code point where ``every`` divides its hash; ``start`` is the crc32 of what precedes it."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 6, least: int = 5, every: int = 199) -> DataFrame:
    """``word, n``: words of ``shortest`` code points or more that occur ``least`` times or more.

    A document's word is hashed once, whatever its occurrences, and batches send sums, so a very
    common word is a few rows a task. NULL texts have no words; a NULL key is written as ''.
    """
    slim = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def work(batches: Batches) -> Iterator[dict]:
        total: Counter[bytes] = Counter()

        def out() -> dict:
            return {"word": [w.decode("latin-1") for w in total], "n": list(total.values())}

        for batch in batches:
            for own_key, own in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                start = zlib.crc32(f"{own_key}:".encode())
                for word, n in Counter(words_of(own)).items():
                    if len(word) >= shortest:
                        word = slipped(word, start, every)
                        if len(word) >= shortest:
                            total[word] += n
            if len(total) > _FLUSH:
                yield out()
                total.clear()
        if total:
            yield out()

    counted = map_batches(slim, work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least)


# Groups -----------------------------------------------------------------------


def _open(words: DataFrame, low: Column, high: Column) -> DataFrame:
    """Rows with their group: those that agree outside ``low .. high`` of the longer word (``size`` code points).

    ``own_size`` is the word's length, ``size`` or one less.
    """
    tail = F.col("size") - high
    outside = F.concat_ws(
        "|", "size", low, high, F.substring("word", F.lit(1), low), F.when(tail > 0, F.substring("word", F.col("own_size") - tail + F.lit(1), tail)).otherwise("")
    )
    return words.select("word", "n", "own_size", "size", low.alias("low"), high.alias("high"), F.md5(outside.cast("binary")).alias("group"))


def groups(words: DataFrame, limit: int = 256) -> DataFrame:
    """``word, n, own_size, size, low, high, group`` of groups of two words or more (an action).

    Two words whose lengths are ``size`` and ``size`` or one less, which are one edit apart, share
    the one group whose interval holds their first difference. A group of more than ``limit`` words
    is cut into two by the position of the edit, until the interval is a single position: there a
    group has at most one word for each letter, and one without.
    """
    size = F.char_length("word").cast("int")
    own = words.select("word", "n", size.alias("own_size"), F.explode(F.array(size, size + 1)).alias("size"))

    def halves(rows: DataFrame) -> DataFrame:
        middle = F.expr("(low + high) div 2").cast("int")
        both = (_open(rows, F.col("low"), middle), _open(rows, middle, F.col("high")))
        return both[0].union(both[1]).where("low < high")

    first = own.withColumn("low", F.lit(0)).withColumn("high", F.col("size"))
    todo, done = stage(halves(first), "halves"), []
    while True:
        counted = todo.groupBy("group").agg(F.count("*").alias("members"), F.max(F.col("high") - F.col("low")).alias("width"))
        sized = stage(counted.where("members > 1"), "sizes")
        large = sized.where((F.col("members") > limit) & (F.col("width") > 1)).select("group", F.lit(True).alias("large"))
        met = stage(join_unique(todo, sized.select("group", (F.col("members").isNotNull()).alias("met")), ["group"]).where("met").drop("met"), "met")
        if large.isEmpty():
            done.append(met)
            break
        told = join_unique(met, large, ["group"])
        done.append(told.where("large is null").drop("large"))
        todo = stage(halves(told.where("large").drop("large", "group")), "halves")
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


# The scan ---------------------------------------------------------------------


def shared_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    at = 0
    while a[at] == b[at]:
        at += 1
    return at


def scan(words: list[str], shared: list[int], at: int) -> Iterator[tuple[int, int]]:
    """Later words of a sorted list one edit from ``words[at]``, each with the length of the prefix the two share.

    ``shared[k]`` is the prefix that words ``k - 1`` and ``k`` share. Row d of the edit matrix holds
    the cells d - 1, d and d + 1 of the word in question, after d code points of the scanned one.
    """
    word, m, n = words[at], len(words[at]), len(words)
    rows = [(FAR, 0, 1)]
    agree = m
    k = at + 1
    while k < n:
        agree = min(agree, shared[k])
        other = words[k]
        del rows[shared[k] + 1 :]
        d = len(rows) - 1
        p0, p1, p2 = rows[d]
        alive = True
        while d < len(other):
            c = other[d]
            d += 1
            # Cells beyond the word or the band cost too much to matter.
            n0 = min(p0 + (word[d - 2] != c), p1 + 1) if 2 <= d <= m + 1 else p1 + 1 if d == 1 else FAR
            n1 = min(p1 + (word[d - 1] != c), p2 + 1, n0 + 1) if d <= m else FAR
            n2 = min(p2 + (word[d] != c), n1 + 1) if d < m else FAR
            if n0 >= FAR and n1 >= FAR and n2 >= FAR:
                alive = False
                break
            rows.append((n0, n1, n2))
            p0, p1, p2 = n0, n1, n2
        if alive:
            if -1 <= m - d <= 1 and (p0, p1, p2)[m - d + 1] == 1:
                yield k, agree
            k += 1
        else:
            # Nothing that begins with other[:d] can be near.
            after = bisect_left(words, other[: d - 1] + chr(ord(other[d - 1]) + 1), k + 1)
            for j in range(k + 1, after):
                if shared[j] < agree:
                    agree = shared[j]
            if after < n and after > k + 1:
                # Rows stay valid for what the next word shares with all that were passed over.
                del rows[min(shared[k + 1 : after + 1]) + 1 :]
            k = after


def near_in_group(rows: list[tuple[str, int]], size: int, low: int, high: int) -> Iterator[tuple[int, int]]:
    """Positions of two words, the longer of ``size``, one edit apart, whose first difference lies in ``low .. high``."""
    words = [w for w, _ in rows]
    shared = [0] + [shared_prefix(a, b) for a, b in zip(words, words[1:], strict=False)]
    for i in range(len(words) - 1):
        for k, agree in scan(words, shared, i):
            if low <= agree < high and max(len(words[i]), len(words[k])) == size:
                yield i, k


def near_words(grouped: DataFrame) -> DataFrame:
    """``word, other, other_n``: both directions of every pair of words one edit apart, each once."""

    def work(batches: Batches) -> Iterator[dict]:
        held: list[tuple[str, int]] = []
        group, bounds = None, (0, 0, 0)
        out: dict[str, list] = {"word": [], "other": [], "other_n": []}

        def settle() -> None:
            for i, k in near_in_group(held, *bounds):
                for (a, _), (b, n) in ((held[i], held[k]), (held[k], held[i])):
                    out["word"].append(a)
                    out["other"].append(b)
                    out["other_n"].append(n)

        for batch in batches:
            for name, word, n, *own in zip(*[batch.column(c).to_pylist() for c in ("group", "word", "n", "size", "low", "high")], strict=True):
                if name != group:
                    if len(held) > 1:
                        settle()
                    held, group, bounds = [], name, tuple(own)
                held.append((word, n))
            if out["word"]:
                yield out
                out = {c: [] for c in out}
        if len(held) > 1:
            settle()
        yield out

    dealt = grouped.select("group", "word", "n", "size", "low", "high").repartition("group").sortWithinPartitions("group", "word")
    return map_batches(dealt, work, "word string, other string, other_n long")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: the end of the chain of forms, found by doubling its steps (an action)."""
    found = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = found.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        after = stage(join_unique(found, step, ["root"]), "roots")
        found = after.select("word", F.coalesce("beyond", "root").alias("root"))
        if after.where("beyond is not null").isEmpty():
            return found


def group_variants(counts: DataFrame, ratio: int = 5, limit: int = 256) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for distinct words ``word, n`` (an action).

    ``form`` is the near word of the largest n (ties: the first in code-point order), if that n is
    at least ``ratio`` times the word's; ``ratio`` of 2 or more keeps the chains of forms without
    loops. Empty tables give no rows; words of any length are compared, however many there are.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words = stage(counts.select("word", "n"), "words")
    pairs = near_words(groups(words, limit))
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best")
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best)
    told = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), (-F.col("best.n")).alias("m"), F.col("best.word").alias("other"))
    enough = F.col("m") >= ratio * F.col("n")
    told = stage(told.select("word", "n", "n_near", F.when(enough, F.col("other")).alias("form"), F.when(enough, F.col("m")).alias("form_n")), "forms")
    ends = roots(told.where("form is not null"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 6, least: int = 5, every: int = 199, ratio: int = 5) -> DataFrame:
    """Spelling variants among the words of all texts; see ``word_counts`` and ``group_variants``.

    Only ``key`` and ``text`` are read. Repeated rows count as often as they stand there.
    """
    return group_variants(word_counts(docs, key, text, shortest, least, every), ratio)


def op13_sorted_scan(spark: SparkSession, folder: str) -> DataFrame:
    return variants(table(spark, folder, "documents"))


#: The near words come from deleting one code point: equal, or equal after a deletion in either.
ORACLE = """
WITH RECURSIVE bits(i, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS l FROM bits WHERE k = 8),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]+')) AS w FROM documents)),
held AS (SELECT id, w, count(*) AS n FROM runs WHERE length(w) >= 6 GROUP BY ALL),
hashed AS (
  SELECT w, n, CAST(xor(list_reduce(
           list_transform(regexp_extract_all(hex(encode(id || ':' || w)), '..'), lambda h: CAST('0x' || h AS BIGINT)),
           lambda a, b: xor(a >> 8, l[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS BIGINT) AS h
  FROM held, steps),
slips AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slips WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
cuts AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS cut FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM cuts a JOIN v b ON a.cut = b.word
  UNION
  SELECT b.word, a.word, a.n FROM cuts a JOIN v b ON a.cut = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(m) AS m, (list(other ORDER BY m DESC, encode(other)))[1] AS other FROM near GROUP BY 1),
told AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * v.n THEN other END AS form, CASE WHEN m >= 5 * v.n THEN m END AS form_n
  FROM v LEFT JOIN best USING (word)),
chain(word, root, next) AS (
  SELECT word, word, form FROM told
  UNION ALL
  SELECT c.word, t.word, t.form FROM chain c JOIN told t ON c.next = t.word)
SELECT t.word, form, root, n, n_near, form_n FROM told t JOIN (SELECT word, root FROM chain WHERE next IS NULL) USING (word)
"""
