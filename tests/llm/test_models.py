"""Operators 2, 8, 9 and 10: scores, quality rules, language ID and the URL filter."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaylake.llm import langid, ppm_score, rules, url_filter
from quaylake.llm.common import id_remainder

SYLLABLES = {"en": ["the", "ing", "and", "er", "th", "wh"], "fr": ["eau", "que", "é", "le", "oi", "ç"],
             "de": ["sch", "ung", "der", "ü", "ich", "ß"]}


def prose(draw, lang, words):
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 3))) for _ in range(words))


# --- PPM ------------------------------------------------------------------------------------

def brute_ppm(rows, held, depth):
    """Scores by a dictionary trie, straight from the definition."""
    lines = [[l.split() for l in (t or "").encode().lower().split(b"\n") if l.split()] for _, t in rows]
    words, known = Counter(), Counter()
    for ls, h in zip(lines, held):
        if not h:
            words.update(w for l in ls for w in l)
            known.update(map(tuple, ls))
    ends = held.count(False)
    total, distinct = sum(words.values()) + ends, len(words) + (ends > 0)
    trie = defaultdict(Counter)
    for w, c in words.items():
        for d, s in enumerate([*w, ppm_score.TERMINATOR]):
            trie[w[:d]][s] += c
    state = lambda n, t: ppm_score._state(np.array([float(n)]), np.array([t]))[0]
    events, short = np.zeros((ppm_score._STATES, 2)), Counter()
    for beginning, node in trie.items():
        n = sum(node.values())
        for symbol, c in node.items():
            if len(beginning) < depth:
                if c > 1:
                    events[state(n - 1, len(node)), 0] += c
                elif n > 1:
                    events[state(n - 1, len(node) - 1), 1] += 1
            before = [ppm_score.START, *beginning][-3:]
            nodes = ppm_score._nodes(before[-1], before[-2] if len(before) > 1 else 0,
                                     before[-3] if len(before) > 2 else 0)
            for order in range(min(3, len(before)) + 1):
                short[nodes[order] * 512 + symbol] += 1
    escapes = ppm_score.escape_table(events)
    contexts = ppm_score.ShortContexts(np.array(list(short), np.int64), np.array(list(short.values()), np.int64))
    if ends:
        trie[b""][ppm_score.END] = ends

    def of_word(w):
        score, symbols = 0.0, [*w, ppm_score.TERMINATOR]
        for d, s in enumerate(symbols):
            node = trie.get(w[:d], {})
            n = sum(node.values())
            escape = escapes[state(n, len(node))] if n else 1.0
            if s in node:
                score += math.log10((1 - escape) * node[s] / n)
                continue
            before = [ppm_score.START, *w[:d]][-3:]
            score += math.log10(escape * contexts.probability(before, s, set(node)))
            return score + (contexts.log_rest(w, d + 1) if s != ppm_score.TERMINATOR else 0)
        return score

    size, once = Counter(), Counter()
    for l, c in known.items():
        size[len(l)] += c
        once[len(l)] += c == 1
    root = trie.get(b"", {})
    n = sum(root.values())
    end = (math.log10((1 - escapes[state(n, len(root))]) * ends / n) if ends
           else -math.log10(ppm_score._SYMBOLS + 1))
    out = []
    for (i, _), ls, h in zip(rows, lines, held):
        score = end
        for l in ls:
            escape = (once[len(l)] + 2) / (size[len(l)] + 4) if size[len(l)] else 1.0
            p = escape * 10 ** sum(map(of_word, l))
            c = known[tuple(l)]
            score += math.log10(p + (c and (1 - escape) * c / size[len(l)]))
        flat = [w for l in ls for w in l]
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in flat)
        base += math.log10((ends + 0.1) / (total + 0.1 * (distinct + 1)))
        out.append((i, h, len(flat) + 1, sum(w in words for w in flat) + (ends > 0), total, base, score))
    return out


def scored(df):
    return sorted(map(tuple, ppm_score.score(df, id_remainder(F.col("doc_id"), 3) == 0).collect()), key=str)


def test_scores_equal_brute_force(spark):
    draw = random.Random(2)
    rows = [(i, "\n".join(prose(draw, draw.choice(["en", "fr", "de"]), draw.randint(1, 6))
                          for _ in range(draw.randint(1, 5)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \n \x0b"), (203, rows[0][1]), (203, rows[0][1]), (None, "no id"),
             (204, "The THE the"), (205, "new\x00word a\x1cb 中文"), (206, "the " * 4000)]
    held = [i is not None and zlib.crc32(str(i).encode()) % 3 == 0 for i, _ in rows]
    df = spark.createDataFrame([(i, t, 0.5, "w") for i, t in rows],
                               "doc_id long, text string, score double, word string")
    got, want = scored(df), sorted(brute_ppm(rows, held, 32), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5]) and g[6] == pytest.approx(w[6])


def test_copies_of_training_lines_score_better(spark):
    draw = random.Random(4)
    rows = [(i, "\n".join(prose(draw, "en", 8) for _ in range(4))) for i in range(60)]
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 0]
    source = next(i for i in range(60) if i not in held)
    rows[held[0]] = (held[0], rows[source][1])
    by_id = {r[0]: r for r in scored(spark.createDataFrame(rows, "doc_id long, text string"))}
    assert by_id[held[0]][6] > by_id[held[0]][5] + 10


def test_probabilities_of_all_symbols_add_up_to_one():
    words = sorted({prose(random.Random(i), "en", 1).encode() for i in range(40)})
    trie = ppm_score.SortedTrie(ppm_score.pa.array([w.decode() for w in words]), np.ones(len(words)), 32)
    short = ppm_score.ShortContexts(*ppm_score.context_counts(trie.words, trie.shared))
    border = {}
    for beginning, symbol, n in trie.border():
        border.setdefault(beginning, {})[symbol] = n
    both = [a + b for a, b in zip(trie.learned()[2].tolist(), ppm_score.learned_on_border(border)[2].tolist())]
    assert len(both) == ppm_score._STATES
    for before in ([ppm_score.START], [ppm_score.START, 116], [116, 104, 101], [1, 2, 3]):
        total = sum(short.probability(before, s, set()) for s in range(ppm_score._SYMBOLS))
        assert total == pytest.approx(1.0)


def test_scores_without_training_texts_or_rows(spark):
    only = next(str(i) for i in range(99) if zlib.crc32(str(i).encode()) % 3 == 0)
    (row,) = scored(spark.createDataFrame([(int(only), "a b")], "doc_id long, text string"))
    assert row[:5] == (int(only), True, 3, 0, 0) and row[5] == 0.0 and row[6] < 0
    assert scored(spark.createDataFrame([], "doc_id long, text string")) == []


def test_probabilities_of_texts_add_up_to_one_at_most(spark):
    texts = [" ".join(["the"] * n) for n in range(1, 7)]
    rows = [(i, texts[i % 6]) for i in range(60)] + [(99, "the\n" * n + "the the") for n in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = F.col("doc_id") == 99
    found = {r["n_tokens"]: 10 ** r["score"] for r in
             ppm_score.score(df, held, layout=True).filter(~held).collect()}
    assert len(found) == 6 and 0.1 < sum(found.values()) < 1
    # As the definition says: 60 lines of 6 kinds, none seen once; a text ends 60.5 times in 121.
    for n_tokens, p in found.items():
        assert p == pytest.approx(0.5 * 0.5 * (1 - 2 / 64) * 10 / 60, rel=0.05), n_tokens
    scores = sorted(r["score"] for r in ppm_score.score(df, held, layout=True).filter(held).collect())
    assert scores[0] < scores[1] - 0.5 and scores[1] < scores[2] - 0.5     # each line costs


def test_words_depend_on_the_words_before(spark):
    draw = random.Random(9)
    rows = [(i, "\n".join(prose(draw, "en", draw.randint(3, 9)) for _ in range(4))) for i in range(60)]
    passage = rows[1][1].split()
    shuffled = draw.sample(passage, len(passage))
    rows += [(100, "\n".join([" ".join(passage[:5]), " ".join(passage[5:])])),      # other wrapping
             (101, "\n".join([" ".join(shuffled[:5]), " ".join(shuffled[5:])])), (102, None), (None, "th")]
    df, held = spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") >= 100
    plain = {r["doc_id"]: r for r in ppm_score.score(df, held, layout=True).collect()}
    given = {r["doc_id"]: r for r in ppm_score.score(df, held, layout=True, words_before=2).collect()}
    assert given[100]["score"] > given[101]["score"] + 5 and given[100]["score"] > plain[100]["score"] + 5
    assert plain[100]["score"] == pytest.approx(plain[101]["score"])
    assert [tuple(given[i])[:6] for i in given] == [tuple(plain[i])[:6] for i in given]
    small = ppm_score.score(df, held, layout=True, words_before=2, docs_per_block=3)
    assert _same(small, ppm_score.score(df, held, layout=True, words_before=2))


def test_run_counts_equal_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(["a b a b", "a\nb\n\nA", "b", "", "a b a c"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "doc_id = 4 AS held_out", "text")
    dealt = ppm_score.blocked(docs, 2, 1000)
    runs = ppm_score.counted_runs(dealt, 2, 7).toArrow()
    want = Counter(tuple(w[i:i + k]) for _, t in rows[:4] for w in [t.lower().split()]
                   for k in (1, 2, 3) for i in range(len(w) - k + 1))
    for b in dealt.collect():
        texts = ppm_score.rows_of(bytes(b["texts"]))
        lines = ppm_score.Lines(texts["text"].combine_chunks())
        seen = ppm_score.SeenRuns(lines, 2, runs.filter(ppm_score.pc.equal(runs["block"], b["block"])))
        words = [lines.dictionary[i].as_py() for i in lines.ids.tolist()]
        for k, (at, c, n) in enumerate(seen.after, 1):
            assert c.tolist() == [want[tuple(words[i - k:i + 1])] for i in at.tolist()]
            assert n.tolist() == [want[tuple(words[i - k:i])] for i in at.tolist()]


def test_blocks_are_bounded_whatever_the_ids(spark):
    draw = random.Random(5)
    rows = [(None if i % 3 else 7, prose(draw, "en", draw.randint(1, 40))) for i in range(300)]
    rows += [(8, "x" * 5000), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "doc_id = 7 AS held_out", "coalesce(text, '') AS text")
    found = ppm_score.blocked(docs, 50, 2000).collect()
    assert len({b["block"] for b in found}) == len(found)
    blocks = [ppm_score.rows_of(bytes(b["texts"])).to_pydict() for b in found]
    for b in blocks:
        assert len(b["text"]) <= 50 and (len(b["text"]) == 1 or sum(len(t.encode()) for t in b["text"]) <= 2000)
    back = [(i, t) for b in blocks for i, t in zip(b["doc_id"], b["text"])]
    assert sorted(back, key=str) == sorted([(i, t or "") for i, t in rows], key=str)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    small = ppm_score.score(df, F.col("doc_id") == 7, docs_per_block=9, bytes_per_block=500)
    assert _same(small, ppm_score.score(df, F.col("doc_id") == 7))


def _same(one, other):
    one, other = (sorted(map(tuple, d.collect()), key=lambda r: (str(r[:5]), r[5])) for d in (one, other))
    return len(one) == len(other) and all(
        a[:5] == b[:5] and a[5:] == pytest.approx(b[5:]) for a, b in zip(one, other))


# --- quality rules --------------------------------------------------------------------------

def brute_counts(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [l for l in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", l)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_counts_and_base_rules(spark):
    draw = random.Random(6)
    texts = [None, "", " ", "one", "a b", "a b c", "a b c a b c", "x x x x x", "a\nb\n\na\n \na", "#*$ %&|<> 中文 é😀",
             "a\x1cb\x85c\xa0d", "w " * 30_000, "l1\n" * 60, "\n".join(["same line here"] * 3)]
    texts += [" ".join(draw.choices("abcd", k=draw.randint(1, 40))) for _ in range(60)]
    texts += [" ".join(f"w{draw.randrange(500)}" for _ in range(draw.randint(45, 120))) for _ in range(20)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, words_ int")
    got = {r["doc_id"]: r for r in rules.judged(df, []).collect()}
    for i, t in enumerate(texts):
        want = brute_counts(t)
        assert tuple(got[i][c] for c in rules.COUNTS) == want, t
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert got[i]["base_failed"] == failed and got[i]["kept"] == (not failed)


def labelled(spark):
    draw = random.Random(7)
    docs, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        words = [f"w{draw.randrange(3000)}{'***' if bad and i % 10 else ''}" for _ in range(90)]
        text = " ".join(words)
        docs.append((i, text.upper() if bad and not i % 10 else text, 1))
        if i < 300:
            labels.append((i, int(not bad), 0))
    labels += [(None, 1, 0), (9, None, 0), (11, 0, 0), (9999, 1, 1), (0, 0, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string, kept int"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_learned_list_separates(spark):
    docs, labels = labelled(spark)
    learned = rules.fit(docs, labels)
    assert 1 <= len(learned) <= 4
    kept = {r["doc_id"] for r in rules.kept_documents(docs, learned).collect()}
    assert kept == {i for i in range(400) if i % 5}
    assert rules.kept_documents(docs, learned).columns == docs.columns
    assert "WHEN" in str(rules.emitted(learned)).upper()
    plan = rules.judged(docs, learned)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_results_can_be_filtered(spark):
    """Filters on any of the columns, alone or joined by others, leave the counts as they are."""
    draw = random.Random(8)
    df = spark.createDataFrame([(i, prose(draw, "en", draw.randint(20, 120)) + (" #$%" * (i % 9)))
                                for i in range(200)], "doc_id long, text string")
    learned = [(rules.Condition("symbol_share", True, 0.02),), (rules.Condition("mean_word", True, 9.0),)]
    out = rules.judged(df, learned)
    rows = out.select("doc_id", "n_words", "n_repeat_words", "base_failed", "kept").collect()
    assert {r["kept"] for r in rows} == {True, False}
    for condition, test in (("kept", lambda r: r["kept"]), ("not base_failed", lambda r: not r["base_failed"]),
                            ("n_words > 60", lambda r: r["n_words"] > 60),
                            ("n_repeat_words = 0 and kept", lambda r: r["kept"] and not r["n_repeat_words"])):
        got = {r["doc_id"] for r in out.filter(condition).select("doc_id").collect()}
        assert got == {r["doc_id"] for r in rows if test(r)}, condition


def test_rare_junk_is_found_beside_imprecise_rules_and_wrong_labels():
    draw = np.random.default_rng(3)
    vague, rare = draw.random(6000), np.zeros(6000)
    labels = (draw.random(6000) >= np.where(vague > 0.6, 0.7, 0.05)).astype(int)   # 5% wrong
    rare[:150] = 1
    labels[:150] = 0
    values = np.stack([vague, rare] + [draw.random(6000) for _ in range(len(rules.FEATURES) - 2)], 1)
    order = draw.permutation(6000)
    learned = rules.learn(values[order], labels[order])
    named = np.zeros(6000, bool)
    for rule in learned:
        named |= np.all([c.holds(values) for c in rule], axis=0)
    assert named[:150].all() and labels[named].mean() <= 0.03


def test_list_without_labels_or_rows(spark):
    docs, labels = labelled(spark)
    assert rules.fit(docs, labels.limit(0)) == [] and rules.fit(docs, labels.filter("quality = 1")) == []
    assert rules.kept_documents(docs.limit(0), []).count() == 0


# --- language ID ----------------------------------------------------------------------------

def test_language_id_on_held_out_texts(spark):
    draw = random.Random(8)
    rows = [(i, prose(draw, lang, draw.randint(5, 60)), lang) for i, lang in enumerate(
        draw.choices(["en", "fr", "de"], k=300))]
    odd = [(900, None, "en"), (901, "", "fr"), (902, "12 !? \n", "de"), (903, "qqqq zzzz xxxx jjjj", None),
           (None, rows[0][1], None), (904, rows[0][1] * 3000, rows[0][2]), (905, "é", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows + odd], "doc_id long, text string, lang string, score string")
    model = langid.fit(df.filter(id_remainder(F.col("doc_id"), 4) != 2))
    got = {r["doc_id"]: r for r in langid.identify(df, model).collect()}
    held = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and sum(got[i]["lang_pred"] == lang for i, lang in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    for i in (900, 901, 902):
        assert tuple(got[i])[1:] == ("und", 0.0, True)
    assert got[903]["lang_pred"] in SYLLABLES and got[903]["rejected"]
    assert not any(got[i]["rejected"] for i, _, _ in rows if len(rows[i][1]) > 60)
    assert got[None]["lang_pred"] == got[904]["lang_pred"] == rows[0][2]
    carried = langid.predict(df, model).select("row.*")
    assert carried.columns == df.columns and carried.count() == df.count()


def test_samples_take_one_row_of_a_repeated_id(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(rules, "learn", lambda values, labels: seen.append(len(values)) or [])
    monkeypatch.setattr(langid, "cluster", lambda own, n: seen.append(len(own)) or own[:1])
    df = spark.createDataFrame([(i if i < 4 else 1, f"text number {i}", "en") for i in range(60)],
                               "doc_id long, text string, lang string")
    rules.fit(df, spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, quality int"))
    langid.fit(df)
    assert seen == [4, 4]


def test_language_id_without_languages_or_rows(spark):
    df = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert [tuple(r) for r in langid.identify(df, model).collect()] == [(1, "und", 0.0, True)]
    assert langid.identify(df.limit(0), model).collect() == []


# --- URL filter -----------------------------------------------------------------------------

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))


def test_hosts_paths_and_rules(spark):
    cases = [
        ("https://A.Example.NET/x?y#z", "a.example.net", "/x", "net/"),
        ("http://example.net/en/5", "example.net", "/en/5", "example.net/en/"),
        ("http://example.net/en", "example.net", "/en", "net/"),
        ("http://example.net?q=/en/", "example.net", "", None),
        ("http://notexample.com/de/1", "notexample.com", "/de/1", None),
        ("http://b.example.com/de/1", "b.example.com", "/de/1", "example.com/de/"),
        ("x://org/fr/://net/", "org", "/fr/://net/", "org/fr/"),
        ("http://net:80/", "net:80", "/", None), ("no scheme", "", "", None), (None, "", "", None),
        ("", "", "", None), ("://", "", "", None), ("http://É.net/\n#", "É.net", "/\n", "net/"),
        ("http://" + "a" * 50_000 + ".net/b", "a" * 50_000 + ".net", "/b", "net/"),
    ]
    df = spark.createDataFrame([(i, c[0], "v") for i, c in enumerate(cases)] + [(None, cases[0][0], "v")],
                               "page_id long, url string, verdict string")
    got = {r["page_id"]: r for r in url_filter.judge(df, RULES).collect()}
    verdicts = {at + path: what for what, at, path in RULES}
    for i, (_, host, path, rule) in enumerate(cases):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        want = verdicts.get(rule) or ("block" if got[i]["block_probability"] >= 0.5 else "allow")
        assert got[i]["verdict"] == want
    assert got[None]["rule"] == "net/"
    assert url_filter.judge(df.limit(0), RULES).collect() == []


def test_model_tells_spam_hosts(spark):
    urls = [("http://www.casino-win.example.org/en/9", "block"), ("https://cheap-pills.example.com/fr/2", "block"),
            ("http://blog.theran.example.com/en/4", "allow"), ("https://www.therti.example.org/es/8.html", "allow")]
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(df, ()).collect()}
    assert got == {i: v for i, (_, v) in enumerate(urls)}


def test_url_model_fits_its_table_and_works_without_one(spark):
    table = [(u.split("/")[2], "/" + u.split("/", 3)[3].split("?")[0].split("#")[0], y) for u, y in url_filter.LABELLED]
    weights, bias = url_filter.fit(table)
    grams, owners = url_filter._features([h for h, _, _ in table], [p for _, p, _ in table])
    z = url_filter._sums(weights, grams, owners, len(table)) + bias
    assert all((z > 0) == np.array([y for _, _, y in table], bool))
    assert url_filter.fit([])[1] < 0
