"""Operators 11 to 13, against brute force and their SQL."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quaylake.llm import hard_negatives, personal_data, registry, token_alignment
from quaylake.llm.pretokens import byte_of_character

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
PARTS = ["a", "B", "é", "Σ", "ß", " ", "  ", "\n", "\t", "\r\n", "\xa0", "'s", "<|endoftext|>", "1", "½", ".",
         ",", "###", "中文", "😀", "́", "word", "the", " of", "tion", "\x00", "<0x41>", "<s>", "﷽", " The"]


# --- alignment ------------------------------------------------------------------------------

def brute_alignments(texts):
    """Token by token, from the definition: byte ranges of all tokens, all overlapping pairs."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    to_byte = byte_of_character()
    out = []
    for text in texts:
        if not text:
            out.append(([], [], [], []))
            continue
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                   else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        whole = (" " + text).encode()
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            out.append(([], [], [], []))
            continue
        ends_a, ends_b = np.cumsum(list(map(len, bytes_a))), np.cumsum(list(map(len, bytes_b)))
        links = [(ids_a[i], ids_b[j]) for i, e in enumerate(ends_a) for j, f in enumerate(ends_b)
                 if e - len(bytes_a[i]) < f and f - len(bytes_b[j]) < e]
        common = sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        groups, at = [], 0
        for cut in common:
            groups.append(",".join(str(i) for i, e in zip(ids_a, ends_a) if at < e <= cut) + "|"
                          + ",".join(str(j) for j, f in zip(ids_b, ends_b) if at < f <= cut))
            at = cut
        out.append((ids_a, ids_b, groups, links))
    return out


def odd_texts(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, 20))) for _ in range(n)]


def test_pieces_and_whole_texts_align_alike():
    tool = token_alignment.aligner(A, B)
    assert tool.separable
    texts = odd_texts(600, 4) + [" ".join(odd_texts(30, 5)), "x" * 3000, "é" * 900, "▁ a", " ", "\n", "a "]
    none = 0
    for text, (ids_a, ids_b, groups, links) in zip(texts, brute_alignments(texts)):
        found = tool.align(text)
        assert (found.n_a, found.n_b, found.n_groups) == (len(ids_a), len(ids_b), len(groups)), text
        assert found.groups == ";".join(groups)
        assert [(x >> 32, x & 0xFFFFFFFF) for x in np.frombuffer(found.links, "<i8").tolist()] == links
        none += bool(text) and not ids_a
    assert none >= 1        # U+2581 in a text comes back as a blank


def test_coarse_cuts_and_decoded_bytes():
    ends = token_alignment.refined_ends(np.array([2, 9, 9, 6]), np.array([True, False, False, True]),
                                        [b"ab", b"\xf0", b"\x9f", b"\x98\x80"])
    assert ends.tolist() == [2, 3, 4, 6]
    assert token_alignment.refined_ends(np.array([2, 9, 5]), np.array([True, False, True]), [b"ab", b"c", b"d"]) is None


@pytest.mark.parametrize("rows, chars", [(8192, 8 << 20), (7, 60)])
def test_corpus_counts(spark, rows, chars):
    """Null, empty and repeated texts and ids, clashing columns; the same for any block size."""
    texts = odd_texts(80, 6) + [None, "", "the word of the word", "the word of the word", "▁", "word " * 4000]
    given = [(None if i % 17 == 3 else i % 40, t, 1, 2) for i, t in enumerate(texts)]
    df = spark.createDataFrame(given, "doc_id long, text string, n_a int, block int").repartition(3)
    brute = brute_alignments(texts)
    docs_of = Counter(pair for *_, links in brute for pair in set(links))
    most = defaultdict(int)
    for (a, _), n in docs_of.items():
        most[a] = max(most[a], n)
    want = sorted((str(g[0]), len(a), len(b), len(groups), len(links),
                   sum(docs_of[x] == most[x[0]] for x in links), sum(docs_of[x] for x in links),
                   hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
                  for g, (a, b, groups, links) in zip(given, brute))
    got = token_alignment.align(df, A, B, rows, chars).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want
    assert token_alignment.align(df.limit(0), A, B).count() == 0


# --- hard negatives -------------------------------------------------------------------------

def test_score_bounds_hold():
    draw = np.random.default_rng(2)
    x = draw.integers(-256, 256, (400, 16)).astype(float)
    x[5] = 0
    x[6:9] = 3 * x[9]
    references = hard_negatives.choose_references(x, 24)
    assert len(references) == 24 and np.allclose((references ** 2).sum(1), 1)
    table, norms = hard_negatives.angles(x, references), np.sqrt((x ** 2).sum(1))
    for at in (5, 6, 9, 17, 200):
        low, upper = hard_negatives.score_bounds(norms[at], table[at], norms, np.ascontiguousarray(table.T))
        scores = x @ x[at]
        assert (low <= scores).all() and (scores <= upper).all()
    assert len(hard_negatives.choose_references(np.zeros((3, 4)), 5)) == 0


def brute_negatives(rows, k=5, percent=80):
    usable = [(i, v, l) for i, v, l in rows if i is not None and l is not None and v is not None
              and all(x is not None and np.isfinite(x) for x in v)]
    ints = [(i, np.floor(256 * np.array(v, float)).astype(int), (l + 1) % 10 if i % 7 == 0 else l)
            for i, v, l in usable]
    out = []
    for n, (anchor, a, label) in enumerate(ints):
        if anchor % 100:
            continue
        rest = [(-int(a @ v), i, l == label) for m, (i, v, l) in enumerate(ints) if m != n and len(v) == len(a)]
        for p, positive, _ in sorted(x for x in rest if x[2])[:k]:
            fit = [(s, i) for s, i, same in rest if not same and percent * -p <= 100 * -s <= 100 * -p]
            out += [(anchor, positive, r + 1, i, -p, -s) for r, (s, i) in enumerate(sorted(fit)[:k])]
    return sorted(out)


def test_hard_negatives_against_brute_force(spark):
    """Repeated ids and rows, ties, zero and empty vectors, vectors of other lengths, nulls."""
    draw = random.Random(3)
    rows = [(i, [draw.choice((-0.5, 0.0, 0.25, 0.5)) for _ in range(6)], draw.randrange(4)) for i in range(420)]
    rows += [(100, rows[7][1], 1), (100, rows[8][1], 1), (200, rows[9][1], 2), rows[50], rows[50],
             (300, [0.0] * 6, 3), (None, rows[1][1], 2), (500, None, 2), (600, rows[2][1], None),
             (700, [1.0, None] + [0.0] * 4, 1), (800, [float("nan")] * 6, 1), (900, [float("inf")] * 6, 1),
             (1000, [], 2), (1001, [], 2), (1002, [], 3), (1100, [0.5, 0.25], 0), (1101, [0.5, 0.5], 0), (1103, [0.5, 0.25], 1)]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows],
                               "vec_id long, embedding array<double>, label int, row int, scores string").repartition(5)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    want = brute_negatives(rows)
    assert len(want) > 100
    for blocks in ({}, {"block_rows": 40, "anchor_rows": 2, "references": 4}):
        got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, label=label, **blocks).collect()
        assert sorted(map(tuple, got)) == want
    con = duckdb.connect()
    con.register("embeddings", df.select("vec_id", "embedding", "label").toArrow())
    assert sorted(con.sql(registry.ORACLE["op12_hard_negatives"]).fetchall()) == want
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []


# --- personal data --------------------------------------------------------------------------

# The contract's rules as they are written.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    return ([("email", *m.span()) for m in EMAIL.finditer(text if "@" in text else "")]
            + [("ip", *m.span()) for m in IP.finditer(text if "." in text else "") if all(int(x) <= 255 for x in m.group().split("."))]
            + [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
            + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15])


def written(spans):
    return ",".join("%s:%d:%d" % s for s in spans)


def card(draw):
    body = "4" + "".join(draw.choices("0123456789", k=14))
    return next(body + d for d in "0123456789" if luhn(body + d))


def test_base_spans_of_odd_texts(spark):
    draw = random.Random(7)
    parts = ["a", ".", "@", "1", "12", "255", "256", "+1 ", "-", " ", "é", "😀", "_", "(555)", "\n", "a@b.c", "1.2.3.4",
             "+4915112345678", "4111111111111111", "4111-1111 1111 1111", "@b.c", "00000001", "x@y", "%"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 25))) for _ in range(800)]
    texts += [None, "", "no identifier", "1" * 60_000, "a" * 60_000, "a." * 1000 + "@", "1-" * 30_000, "+1" * 20_000,
              "a@" + "b." * 30_000 + "c", "a@b.c_d@e.f", "x" * 40_000 + " 1.2.3.4"]
    df = spark.createDataFrame([(i % 700, t, "n") for i, t in enumerate(texts)],
                               "doc_id long, text string, row string").repartition(3)
    got = personal_data.extract(df).collect()
    want = sorted((i % 700, hashlib.sha256(written(brute_spans(t or "")).encode()).hexdigest(),
                   *(sum(s[0] == k for s in brute_spans(t or "")) for k in personal_data.KINDS))
                  for i, t in enumerate(texts))
    assert sorted((r["doc_id"], r["base_sha256"], *(r[f"n_{k}"] for k in personal_data.KINDS)) for r in got) == want
    by_id = defaultdict(list)
    for i, t in enumerate(texts):
        by_id[i % 700].append(t or "")
    for r in got:       # base ones stay
        assert any(set(filter(None, written(brute_spans(t)).split(","))) <= set(r["spans"].split(","))
                   for t in by_id[r["doc_id"]])
    assert personal_data.extract(df.limit(0)).count() == 0
    assert personal_data.extract(df.filter("text is null or text = ''")).select("spans").distinct().collect() == [("",)]


def test_patterns_discover_what_the_rules_miss(spark):
    """Numbers that run into each other, and identifiers whose form no rule has, told by their
    context alone; other numbers in clean texts are left alone."""
    draw = random.Random(9)
    words = lambda n: " ".join("".join(draw.choices("abcdefghij", k=4)) for _ in range(n))
    phone = lambda: f"+1 ({draw.randrange(100, 999)}) 555-{draw.randrange(1000, 9999)}"
    texts = [f"{words(9)} please call us {phone()} {words(9)}" for _ in range(60)]
    texts += [f"{words(5)} {card(draw)} {words(6)}" for _ in range(60)]
    texts += [f"{words(5)} {draw.randrange(1, 255)}.{draw.randrange(255)}.{draw.randrange(255)}.7 {words(6)}" for _ in range(60)]
    one, two, tel = card(draw), card(draw), phone()
    hard = [(f"{words(4)} {one} {two} {words(4)}", {("card", one), ("card", two)}),
            (f"{words(4)} {tel} {one} {words(4)}", {("phone", tel), ("card", one)}),
            (f"{words(4)} {one} 53.121.55.90 {words(4)}", {("card", one), ("ip", "53.121.55.90")}),
            (f"{words(4)} please call us 555-0123 {words(4)}", {("phone", "555-0123")})]
    clean = [f"{words(9)} version 2.0 {words(9)} 12345 {words(4)} 4111111111111112 {words(3)}" for _ in range(40)]
    clean.append(f"{words(3)} 4111111111111112 4111111111111113")
    given = texts + [t for t, _ in hard] + clean
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in personal_data.extract(df).collect()}

    def spans(i):
        return {(k, given[i][int(s):int(e)]) for k, s, e in (x.split(":") for x in got[i]["spans"].split(",") if x)}

    assert all(got[i]["n_added"] == 0 and len(spans(i)) == 1 for i in range(len(texts)))
    for at, (_, want) in enumerate(hard, len(texts)):
        assert spans(at) == want
    assert all(not spans(i) for i in range(len(texts) + len(hard), len(given)))


def test_scores_equal_a_plain_computation(spark):
    draw = random.Random(5)
    edges = {(f"v{draw.randrange(40)}", f"p{draw.randrange(12)}") for _ in range(150)}
    seeds = {(f"v{i}", draw.choice(personal_data.KINDS)) for i in range(20)}
    known = {s: 1.0 for s in seeds}
    values = defaultdict(set)
    for v, p in edges:
        values[p].add(v)
    named = {v for v, _ in seeds}
    for _ in range(3):
        patterns = {}
        for p, vs in values.items():
            for k in personal_data.KINDS:
                if sum((v, k) in seeds for v in vs) >= 2:
                    patterns[p, k] = sum(known.get((v, k), 0) for v in vs) / (len(vs) + 1)
        known = {s: 1.0 for s in seeds}
        for (p, k), score in patterns.items():
            for v in values[p] - named:
                known[v, k] = max(known.get((v, k), 0), score)
    want = {x: s for x, s in known.items() if x[0] not in named}
    got = personal_data.scored(spark.createDataFrame(sorted(edges), "value string, pattern string"),
                               spark.createDataFrame(sorted(seeds), "value string, kind string"), 3, 2)
    found = {(r["value"], r["kind"]): r["score"] for r in got.collect()}
    assert want and found.keys() == want.keys() and all(abs(found[x] - want[x]) < 1e-9 for x in want)


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(i, f"a{i}@b.cd") for i in range(9)], "doc_id long, text string")
    plan = personal_data.extract(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
