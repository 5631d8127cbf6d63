"""Language families, source divergence and the Merkle manifest against brute-force versions."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SMALL
from oracle_check import connect, difference

import __spark_entry__ as entry_point
from ripplelake.llm import divergence, language, manifest, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos int, id int, n int, term string, value int"


def table(spark, rows):
    """Rows of (doc_id, text, lang, source, n_chars), with more columns whose names the operators use within."""
    return spark.createDataFrame([(*r, "t", 1, 2, 3, "x", None) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("name", ["op12_source_divergence", "op13_merkle_manifest"])
def test_same_as_sql(spark, name):
    assert difference(connect(SMALL), entry_point.queries()[name](spark, SMALL), entry_point.oracle_sql()[name]) is None


# Language families


def sequences(words):
    """The 1 to 4 letter sequences of words with marked ends, one by one."""
    found = []
    for w in words:
        marked = f" {w} "
        for n in range(1, 5):
            found += [g for g in (marked[i : i + n] for i in range(len(marked) - n + 1)) if g != " " and (n > 2 or " " * n != g)]
    return found


def place_of(g):
    code = 0
    for i, c in enumerate(g):
        code = (ord(c) if i == 0 else code * 0x100000001B3 + ord(c)) % 2**64
    return ((code + len(g)) * 0x9E3779B97F4A7C15 % 2**64) >> (64 - language.PLACES)


def test_letter_sequences():
    words = ["a", "ab", "éß", "straße", "a" * 50, "語"]
    at, owner = language.places(words)
    assert collections.Counter(at.tolist()) == collections.Counter(map(place_of, sequences(words)))
    for i, w in enumerate(words):
        assert sorted(at[owner == i].tolist()) == sorted(map(place_of, sequences([w])))


def test_words_of_long_texts():
    text = "ab1cd x²y _é_ " * 9 + "z" * 40
    whole = [w for part in language.runs(text) for w in part]
    assert whole == re.findall(r"[^\W\d_]+", text.replace("²", "")) and whole[2] == "xy"
    for size in (1, 7, 50):
        assert [w for part in language.runs(text, size) for w in part] == whole


STEMS = {"en": "the and of thing", "de": "der und schön ung", "fr": "les aux être eux", "es": "los ción año que", "xx": "qq zz kx vv"}


def text_in(lang, rng, n):
    return " ".join(rng.choice(STEMS[lang].split()) + rng.choice(["", "a", "en"]) for _ in range(n))


def test_languages_are_told_apart(spark):
    rng = random.Random(4)
    rows = [(i, text_in(lang, rng, rng.randrange(3, 60)), lang, "s", 1) for i, lang in enumerate(itertools.islice(itertools.cycle(STEMS), 400))]
    odd = [(1000, None, "en", None, None), (1001, "", "en", "", 0), (1002, "12 --- ² ½", "en", "s", 0), (None, "the thing", "en", "s", 0),
           (1003, "the " * 60000, None, "s", 0), (1004, "Ⅷ", "de", "s", 1), rows[0], rows[0]]
    docs = table(spark, rows + odd)
    model = language.train(docs, sample_rows=300)
    assert model.members == {"Germanic": ["de", "en"], "Romance": ["es", "fr"], "only xx": ["xx"]}
    out = collections.defaultdict(list)
    for r in language.predict(docs, model).collect():
        out[r.doc_id].append(r)
    assert sum(map(len, out.values())) == len(rows) + len(odd)
    for doc_id, text, lang, *_ in rows:
        assert out[doc_id][0].held_out == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert 0 <= out[doc_id][0].score <= 1 and len(set(out[doc_id])) == 1
    held = [r for r in rows if out[r[0]][0].held_out]
    assert len(held) > 50 and sum(out[r[0]][0].lang_pred == r[2] for r in held) >= 0.97 * len(held)
    assert all((out[i][0].lang_pred, out[i][0].score) == ("und", 0.0) for i in (1000, 1001, 1002))
    assert (out[None][0].held_out, out[None][0].lang_pred, out[1003][0].lang_pred) == (False, "en", "en")
    # Whole texts word by word, without the table of known words, give the same sums and the same decision.
    reader = language.Reader(model)
    for text in [r[1] for r in rows[:40]] + ["the " * 999 + "und " * 1001]:
        each = [model.weights[language.places([w])[0]].astype(float).sum(0) for w in text.lower().split()]
        pred, score = model.decide(np.sum(each, 0), np.abs(each).sum(0))
        assert (reader(text)[0], reader(text)[1]) == (pred, pytest.approx(score, abs=1e-4))
    # Nothing about a row but its text decides.
    moved = docs.withColumnsRenamed({"lang": "source", "source": "lang"}).withColumn("lang", docs["n_chars"].cast("string"))
    again = {(r.doc_id, r.lang_pred, r.score) for r in language.predict(moved, model).collect()}
    assert again == {(r.doc_id, r.lang_pred, r.score) for rs in out.values() for r in rs}


def test_only_rows_with_a_label_outside_the_held_out_part_teach(spark):
    rng = random.Random(5)
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, text_in("fr", rng, 20), "fr", "s", 1) for i in ids] + [(i, "the thing", "en", "s", 1) for i in range(400) if i not in ids][:9]
    rows += [(None, text_in("de", rng, 20), "de", "s", 1), (5000, "les aux", None, "s", 1)]
    docs = table(spark, rows)
    assert language.train(docs).members == {"Germanic": ["en"]}
    assert {r.lang_pred for r in language.report(docs).collect()} == {"en"}
    assert {r.lang_pred for r in language.report(table(spark, rows[:3])).collect()} == {"und"}
    assert language.report(table(spark, rows).where("false")).count() == 0


def test_machine_separates_and_balances():
    rng = np.random.default_rng(3)
    rows = [(np.array([0, 2]), np.array([1.0, 0.1 * rng.random()])) for _ in range(5)] + [
        (np.array([1, 2]), np.array([1.0, 0.1 * rng.random()])) for _ in range(200)
    ]
    w = language.machine(rows, np.arange(len(rows)) < 5)
    assert all((w[at] @ x > 0) == (i < 5) for i, (at, x) in enumerate(rows))


# Source divergence


def diverging(rows, least, top):
    counts, documents, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = ["".join(c.lower() if c < "\x80" else c for c in t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang, source].update(terms)
        documents[lang].update(set(terms))
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in documents[lang].items() if n >= least]
        sources = [s for g, s in groups if g == lang]
        counts[lang, None] = sum((counts[lang, s] for s in sources), collections.Counter())
        p = {}
        for s in [*sources, None]:
            total = sum(counts[lang, s][t] for t in kept)
            p[s] = {t: 1 + 10**9 * (counts[lang, s][t] + 2) // (total + 2 * len(kept)) for t in kept}
        for s in sources:
            f = lambda other, t: (p[s][t] - p[other][t]) ** 2 // (p[s][t] + p[other][t])  # noqa: E731, B023
            pairs = sorted((-sum(f(o, t) for t in kept), o.encode()) for o in sources if o != s)
            more = [t for t in kept if counts[lang, s][t] and p[s][t] > p[None][t]]
            terms = sorted((-f(None, t), t.encode()) for t in more)[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)]
    return sorted(out)


def zipf(rng, n):
    words = [f"W{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)] + ["É", "é", "ß", "語"]
    return " ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=n))


@pytest.mark.parametrize("options", [{}, {"least": 2, "top": 3, "block": 16, "bin_size": 2}])
def test_divergence(spark, options):
    rng = random.Random(6)
    sources = [None, "", "a", "b", "c", "é", "dd"]
    rows = [(i, zipf(rng, rng.randrange(60)), rng.choice([None, "en", "de"]), rng.choice(sources), 1) for i in range(300)]
    rows += [(i, t, "en", "odd", None) for i, t in enumerate([None, "", "1 2 3", "Wa wa WA_wa\nÉ"])] + [(1, "one", "rare", s, 1) for s in "xyz"]
    rows += [(7, "Wa wb " * 200000, "en", "long", 1), (8, "alone", "single", "s", 1), rows[0], rows[0]]
    got = sorted(tuple(r) for r in divergence.audit(table(spark, rows), **options).collect())
    assert got == diverging(rows, options.get("least", 10), options.get("top", 10))
    assert [r for r in got if r[0] == "rare"] and all(r[4] == 0 for r in got if r[0] == "rare")


def test_divergence_of_nothing(spark):
    assert divergence.audit(table(spark, [(1, "a", "en", "s", 1)]).where("false")).count() == 0
    assert divergence.audit(table(spark, [(1, "a b", "en", "s", 1)])).count() == 0


def test_gallop_and_prices():
    rng = np.random.default_rng(1)
    for few, many in ((0, 5), (5, 0), (1, 1), (3, 5000), (5000, 3), (700, 900), (2000, 2000)):
        a, b = (np.sort(rng.choice(6000, n, replace=False)) for n in (few, many))
        assert (divergence.gallop(a, b) == np.searchsorted(b, a)).all()
        x, y = divergence.Side(a, a % 7 + 1, 90000, 6000), divergence.Side(b, b % 5 + 1, 1234, 6000)
        p = [dict(zip(s.ids.tolist(), s.p.tolist())) for s in (x, y)]
        every = [(p[0].get(i, x.absent), p[1].get(i, y.absent)) for i in range(6000)]
        expected = sum((i - j) ** 2 // (i + j) for i, j in every)
        assert divergence.pair_price(x, y, 6000) == divergence.pair_price(y, x, 6000) == expected


def test_frequencies_of_huge_counts_are_exact(spark):
    rows = [(0, 0, 1), (10**12, 3 * 10**12, 10**7), (5, 5, 1), (10**15, 10**15, 10**8), (7, 10**15, 10**9)]
    exact = [1 + 10**9 * (n + 2) // (total + 2 * v) for n, total, v in rows]
    assert [int(divergence.frequencies(np.array([n]), total, v)[0]) for n, total, v in rows] == exact
    df = spark.createDataFrame(rows, "n long, total long, v long")
    col = df.select("n", "total", "v", divergence.frequency(df["n"], df["total"], df["v"]).alias("p"))
    assert {tuple(r)[:3]: r["p"] for r in col.collect()} == dict(zip(rows, exact))


# Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([sha(*found[-1][i : i + 3]) for i in range(0, len(found[-1]), 3)])
    return found


def beside(tree, i):
    path = []
    for nodes in tree[:-1]:
        first = i - i % 3
        path.append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + 3])))
        i //= 3
    return path


def plain_manifest(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha(*map(field, (r[0], r[3], r[2], r[4], text)))
    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[r[3]].append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append(levels([leaf(r, r[1]) for r in by_source[s]]))
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(by_source[s]):
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            node = leaf(r, r[1].replace("\n", "") if even and r[1] is not None else r[1])
            path = beside(trees[k], i) + beside(top, k)
            for left, right in path:
                node = sha(left, node, right)
            out.append((r[0], leaf(r, r[1]), trees[k][-1][0], top[-1][0], sha(*map("".join, path)), node, node == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("n, depth", [(1, 7), (3, 1), (60, 1), (240, 2), (240, 7)])
def test_manifest(spark, n, depth):
    rng = random.Random(n)
    source = lambda: rng.choice(["a"] * 9 + [None, "", "b", "é", "aaa"] + [f"s{i}" for i in range(40)])
    rows = [
        (rng.choice([None, *range(2 * n)]), rng.choice([None, "", "x\ny", "é\n", "long " * 5000]), rng.choice([None, "en"]), source(), rng.choice([None, 4]))
        for _ in range(n)
    ]
    rows += rows[:3] + rows[:1] * 4
    got = sorted((tuple(r) for r in manifest.manifest(table(spark, rows), depth).collect()), key=str)
    assert got == plain_manifest(rows)
    assert n < 60 or {r[-1] for r in got} == {True, False}


def test_manifest_of_nothing(spark):
    assert manifest.manifest(table(spark, [(1, "a", "en", "s", 1)]).where("false")).count() == 0


def test_places_in_the_log():
    """The closed form names the place at which each node of each level was appended."""
    for height in range(4):
        for n in range(1, 3**height + 1):
            nodes = [[f"{i}" for i in range(n)]]
            for _ in range(height):
                nodes.append([manifest.digest("".join(nodes[-1][i : i + 3])) for i in range(0, len(nodes[-1]), 3)])
            log = manifest.append_log(nodes[0], height)
            assert len(log) == sum(map(len, nodes))
            for level, row in enumerate(nodes):
                for i, node in enumerate(row):
                    assert log[manifest.place(level, i, n, height)] == node


def test_rows_without_an_id_are_not_held_out(spark):
    docs = table(spark, [(i, "a b", "en", "s", 1) for i in (None, 1, 2, 3, None)])
    marks = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, toxic int")
    found = collections.Counter((r.doc_id, r.held_out) for r in toxicity.report(docs, marks).collect())
    assert found == {(None, False): 2, **{(i, zlib.crc32(str(i).encode()) % 3 == 1): 1 for i in (1, 2, 3)}}
