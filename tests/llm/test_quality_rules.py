import math
import re
from collections import Counter

import numpy as np
import pytest
from support import DOCUMENT, documents, odd_rows, prose

from tillmark.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines, seen, again = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 10 or 100 * len(inside) > 20 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(inside), failed


TEXTS = [
    "a b c d e a b c d e f", "x " * 40, "one\ntwo\none\n\n\n two\ntwo", "#*$ <b> | " * 30, "a b c d e f g h i j " + prose(3, 60),
    "\x85  a b 東京" * 5, "w1 w2 w3 w4 w5 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11",
]


def test_base_statistics_equal_brute_force(spark):
    rows = odd_rows() + [(100 + i, t) for i, t in enumerate(TEXTS)]
    got = q.quality(documents(spark, rows, clashes=False), {}, carry=("doc_id", "source")).collect()
    found = sorted(((r.doc_id, *r[2:8]) for r in got), key=repr)
    assert found == sorted(((i, *brute(t)) for i, t in rows), key=repr)
    assert all(r.kept is not r.base_failed for r in got)  # without references the base rules decide


def test_clean_texts_stay_and_junk_goes(spark):
    rng = np.random.default_rng(0)
    function_words = ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it"]

    def text(i):
        rest = [f"w{x}ord" for x in rng.integers(0, 5000, 120)]
        return " ".join(function_words[int(rng.integers(10))] if rng.random() < 0.4 else w for w in rest) + "."

    clean = [(i, text(i)) for i in range(1, 200) if i % 5]
    junk = [(1000, " | ".join(f"{x}%$#" for x in rng.integers(0, 9999, 200))), (1001, " ".join(f"QX{x}!!" for x in rng.integers(0, 99999, 200)))]
    df = documents(spark, clean + junk)
    kept = {r.doc_id for r in q.quality(df, q.references(df)).where("kept").collect()}
    assert kept == {i for i, _ in clean} | set()


def tagged(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, len(t)) for i, (t, lang) in enumerate(rows)], DOCUMENT)


def plain(seed, usual, n=200):
    """Lower-case words, of which 40 % are ``usual`` ones."""
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    return " ".join(str(rng.choice(usual)) if rng.random() < 0.4 else "".join(rng.choice(letters, 7)) for _ in range(n))


def test_every_language_gets_a_reference_and_rare_tags_exempt_nothing(spark):
    usual = ["the", "of", "and", "to", "in", "is"]
    rows = [(plain(100 * k + i, usual), f"l{k:02}") for k in range(70) for i in range(3)]
    junk = " ".join(f"{x}%$#" for x in range(200))
    known = q.references(tagged(spark, [*rows, (junk, "rare")]), least=3)
    assert set(known) == {f"l{k:02}" for k in range(70)}
    more = tagged(spark, [*rows, (junk, "l69"), (junk, "rare"), (junk, None), (plain(9999, usual), "rare")])
    lost = {r.doc_id for r in q.quality(more, known).where("not kept").collect()}
    assert lost == {210, 211, 212}


def test_common_words_of_any_script_and_length_count(spark):
    usual = ["который", "только", "нельзя", "между"]
    rows = [(plain(i, usual), "ru") for i in range(30)] + [(plain(99, ["zwischen", "dergleichen"]), "de")] * 20
    known = q.references(tagged(spark, rows))
    assert {w.encode() for w in usual} <= set(known["ru"][1])
    assert {b"zwischen", b"dergleichen"} <= set(known["de"][1])
    every = Counter(w for t, lang in rows if lang == "ru" for w in t.split())
    assert [known["ru"][1][w.encode()] for w in usual] == pytest.approx([every[w] / every.total() for w in usual])
    salad = plain(7, [f"ню{x}ню" for x in range(400)])
    assert q.judge(salad, "ru", q.References({"ru": known["ru"]}))[6] is False


def test_text_under_a_wrong_tag_goes(spark):
    usual = {"de": ["zwischen", "dergleichen", "und"], "ru": ["который", "только", "нельзя"]}
    rows = [(plain(i, usual[lang]), lang) for lang in usual for i in range(30)]
    known = q.references(tagged(spark, rows))
    told = [("de", "de"), ("de", "ru"), ("ru", "de"), ("ru", "ru"), ("de", "dee"), ("ru", None)]
    more = tagged(spark, [(plain(500 + i, usual[of]), tag) for i, (of, tag) in enumerate(told)])
    kept = {r.doc_id: r.kept for r in q.quality(more, known).collect()}
    assert [kept[i] for i in range(len(told))] == [True, False, False, True, True, True]


def entropy(p):
    return -sum(x * math.log2(x) for x in p if x > 0)


def verdict(text, lang, known, limits):
    """The verdict recomputed word by word and character by character, without numpy."""
    n, *_, failed = brute(text)
    if failed or not n:
        return not failed
    found = [w.encode() for w in WORD.findall(text)]

    def against(name):
        classes, usual = known[name]
        seen = Counter()
        for w in found:
            bare = w[:-1] if w[-1:] in (b".", b",", b";", b":", b"!", b"?") else w
            for u in usual:
                if w == u or bare in (u, u.capitalize(), u.upper()):
                    seen[u] += 1
        p = [seen[u] / n for u in usual]
        p.append(1 - sum(p))
        r = [*usual.values()]
        r.append(1 - sum(r))
        apart = entropy([(x + y) / 2 for x, y in zip(p, r)]) - (entropy(p) + entropy(r)) / 2
        kinds = Counter(int(q._class_of()[ord(c)]) for c in text)
        c = [kinds[k] / len(text) for k in range(len(q.CLASSES))]
        chars = entropy([(x + y) / 2 for x, y in zip(c, classes)]) - (entropy(c) + entropy(classes)) / 2
        return max(0.0, apart), max(0.0, chars), sum(p[:-1]), sum(r[:-1])

    apart, chars, share, usual = against(lang) if lang in known else min(against(name) for name in known)
    low = limits.scant * usual
    few = share < low and n * ((1 - share) * math.log((1 - share) / (1 - low)) + (share * math.log(share / low) if share else 0)) > -math.log(limits.chance)
    by_words = n >= limits.min_words and (few or apart > limits.word_divergence + limits.word_slack / n)
    by_chars = len(text) >= limits.min_chars and chars > limits.char_divergence + limits.char_slack / len(text)
    return not (by_words or by_chars)


def test_verdict_equals_a_plain_recomputation(spark):
    usual = {"de": ["zwischen", "dergleichen", "und"], "ru": ["который", "только", "нельзя"], "en": ["the", "of", "is"]}
    rows = [(plain(i, usual[lang]), lang) for lang in usual for i in range(25)]
    known = q.references(tagged(spark, rows))
    rng = np.random.default_rng(3)
    texts = []
    for i in range(300):
        lang = ["de", "ru", "en"][i % 3]
        text = plain(1000 + i, usual[lang], int(rng.integers(8, 300))).split()
        for at in range(len(text)):  # from clean texts to junk
            if rng.random() < (i % 10) / 12:
                text[at] = str(rng.choice(["Und,", "THE", "the.", "|%$", "4711", "QX", "Zwischen!", "word"]))
        texts.append((" ".join(text), [lang, lang, "en", None, "xx"][i % 5]))
    got = {r.doc_id: r.kept for r in q.quality(tagged(spark, texts), known).collect()}
    expected = {i: verdict(t, lang, known, q.Limits()) for i, (t, lang) in enumerate(texts)}
    assert got == expected and 50 < sum(got.values()) < 250


def test_registered_query(spark, tmp_path):
    tagged(spark, [(plain(i, ["the", "of"]), "en") for i in range(25)] + [("", "en"), ("", None)]).write.parquet(str(tmp_path / "documents.parquet"))
    got = q.op8_quality_rules(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got if r.kept) == list(range(25)) and len(got) == 27


@pytest.mark.parametrize("n", [40, 60, 100, 1000])
@pytest.mark.parametrize("share", [0.36, 0.1])
def test_text_without_common_words_goes_as_soon_as_chance_allows(n, share):
    usual = {f"c{i}".encode(): share * (60 - i) / 1830 for i in range(60)}
    known = q.References({"xx": (q.class_counts(plain(0, ["abc"])) / len(plain(0, ["abc"])), usual)})
    rng = np.random.default_rng(n)
    weights = [*usual.values(), 1 - share]
    salad = plain(n, ["zzzzzzz"], 4 * n).replace("zzzzzzz ", "").split()[:n]
    assert len(salad) == n
    expected = (1 - share / 2) ** n > q.Limits().chance  # so rare a language leaves short texts without any
    assert expected is (share == 0.1 and n < 135)
    assert q.judge(" ".join(salad), "xx", known)[6] is expected
    for _ in range(200):
        drawn = rng.choice(61, n, p=weights)
        held = sum(1 for k in drawn if k < 60)
        assert not q.too_few(n, held / n, share, q.Limits())


def test_divergence_has_its_bounds():
    p, r = np.array([[1.0, 0.0]]), np.array([[0.0, 1.0]])
    assert q.divergence(p, r)[0] == pytest.approx(1) and q.divergence(p, p)[0] == 0
    assert q.divergence(p, np.array([[0.5, 0.5]]))[0] == pytest.approx(q.divergence(np.array([[0.5, 0.5]]), p)[0])


def test_short_texts_are_not_judged_by_divergence(spark):
    known = {"en": (np.eye(len(q.CLASSES))[1], {b"the": 0.5})}
    row = q.judge("1 2 3 4 5 6 7 8 9 10 11", "en", q.References(known))
    assert row[6] is True


def test_references_do_not_need_all_columns(spark):
    df = documents(spark, odd_rows(), clashes=True)
    assert q.references(df) == {}  # fewer documents than a reference needs
    assert q.quality(df, {}).count() == len(odd_rows())
    assert q.quality(documents(spark, []), {}).collect() == []
    assert q.references(documents(spark, [])) == {}
