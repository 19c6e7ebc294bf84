import random
import re

from strata.llm.quality_rules import apply_quality_rules, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    mark = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            mark |= {i, i + 1, i + 2}
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": len(mark), "base_failed": n < 50 or 100 * len(mark) > 50 * n,
    }


def prose(rng, n, vocabulary=4000):
    words = [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    return "\n".join(" ".join(words[i:i + 9]) for i in range(0, n, 9))


def test_base_counts_match_brute_force(spark, documents):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a", "a b", "a b c a b c", "x y\u0085z \x0b\x0c w", "a\r\nb\r\na\r\nb",
             "l\nl\n l\nl \n\n", "#*$%&|<>\n" * 60, "é ö 漢字 😀 #" * 40]
    texts += [prose(rng, rng.randrange(1, 200), 12) for _ in range(60)]
    texts.append(" ".join(f"t{i % 700}" for i in range(60_000)))
    docs = documents([(i, t, "en", "s") for i, t in enumerate(texts)], extra=("host", "lines", "kept"))
    got, _ = quality_rules(spark, docs)
    rows = {r.doc_id: r.asDict() for r in got.collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts[:-1]):
        want = brute(t)
        assert {k: rows[i][k] for k in want} == want, (i, t)
    assert rows[len(texts) - 1]["n_repeat_words"] == 60_000


def test_boilerplate_goes_and_copies_stay(spark, documents):
    rng = random.Random(5)
    footer = "Read   our TERMS and the notice of this site\nall rights are kept by the owner of it"
    rows = [(i, prose(rng, 80) + "\n" + footer, "en", "a") for i in range(40)]
    menu = "\n".join([footer.lower().replace("  ", " ")] * 4)
    rows += [(100 + i, menu.replace("\nall", f"\n{i} all", 1), "en", "a") for i in range(3)]
    rows += [(200, menu, "en", "b")]  # rare in its own host
    base = prose(rng, 90).split("\n")  # a group of near copies
    rows += [(300 + i, "\n".join([f"copy {i}", *base]), "en", None) for i in range(60)]
    rows += [(400 + i, "\n".join(base), "en", "a") for i in range(60)]  # exact copies
    docs = documents(rows, extra=("key",))
    verdicts, _ = quality_rules(spark, docs, min_docs=10)
    kept = {r.doc_id: (r.kept, r.left_words, r.n_words) for r in verdicts.collect()}
    for i in range(40):
        assert kept[i] == (True, 80, 80 + 18)
    for i in range(3):
        assert kept[100 + i][0] is False
    assert all(kept[300 + i][0] and kept[400 + i][0] for i in range(60))
    out = {r.doc_id: r for r in apply_quality_rules(spark, docs, min_docs=10).collect()}
    assert "TERMS" not in out[0].text and out[0].n_chars == len(out[0].text)
    assert out[300].text == rows[[r[0] for r in rows].index(300)][1]
    assert 100 not in out and out[0].key == "x"


def test_empty_table(spark, documents):
    docs = documents([])
    verdicts, _ = quality_rules(spark, docs)
    assert verdicts.count() == 0
    assert apply_quality_rules(spark, docs).columns == docs.columns


def test_limit_does_not_grow_with_the_host(spark, documents):
    """Of 15,000 texts 25 are pages of shared lines; six pages with text of their own vouch for these lines."""
    rng = random.Random(9)
    menu = [f"menu entry {k} of this site with a few words" for k in range(8)]
    rows = [(i, "\n".join([*menu, f"{i}"]), "en", "a") for i in range(25)]
    rows += [(100 + i, "\n".join([prose(rng, 200, 10**6), *menu]), "en", "a") for i in range(6)]
    rows += [(1000 + i, f"text {i}", "en", "a") for i in range(15_000)]
    verdicts, _ = quality_rules(spark, documents(rows))
    kept = {r.doc_id: (r.kept, r.left_words) for r in verdicts.where("doc_id < 1000").collect()}
    assert all(kept[i] == (False, 1) for i in range(25))
    assert all(kept[100 + i] == (True, 200) for i in range(6))
