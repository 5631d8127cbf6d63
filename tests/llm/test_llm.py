"""Each operator against a brute-force version on small tables: nulls, empty and long texts, ties, repeats, odd columns."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from conftest import SMALL
from oracle_check import connect, difference

import __spark_entry__ as entry_point
import corpus_pipeline
from ripplelake.llm import (
    arc, decontaminate, line_templates, packing, quality, sharding, simhash, suffix_dedup, tokens, toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, H string, kept_id int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
random.seed(5)
VOCABULARY = ["".join(random.choices("abdeilnorstu", k=random.randrange(2, 8))) for _ in range(400)]


def prose(n, lines=1):
    return "\n".join(" ".join(random.choices(VOCABULARY, k=n)) for _ in range(lines))


SHARED = prose(60)
BASE = prose(300)
TEXTS = [
    None, "", " \n\t", "one", prose(25), prose(400, 5), BASE, BASE, BASE.replace(" ", "  ", 1), prose(30) + " " + SHARED,
    prose(40) + "\n" + SHARED + "\n" + prose(10), "x" * 3000, "ab " * 2000, prose(9000), "É" * 60 + " ß", "!! " * 50, "AAA BBB! " * 30,
    prose(7), BASE[:-5] + "zzz", "a\r\n\r\nb",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None, 0, "w", "h", 1) for i, t in enumerate(TEXTS)] + [(len(TEXTS), BASE, None, "s", None, None, None, None)]
    return spark.createDataFrame(rows + [rows[6]], SCHEMA).repartition(4).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality_figures_and_verdict(docs, empty):
    got = collections.defaultdict(list)
    for r in quality.report(docs).collect():
        got[r.doc_id].append(r)
    for row in docs.collect():
        text = row.text or ""
        words = WORD.findall(text)
        windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        r = got[row.doc_id][0]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
    assert quality.report(empty).count() == 0
    kept = quality.kept(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, rs in got.items() if rs[0].kept}


def test_quality_matches_sql(spark):
    name = "op2_quality_cascade"
    assert difference(connect(SMALL), entry_point.queries()[name](spark, SMALL), entry_point.oracle_sql()[name]) is None


def test_line_templates(spark, empty):
    rows = [(i, f"{prose(30)}\nRelease {i} of the common notes is out now\n{prose(20)}\nAll rights are reserved here by law") for i in range(12)]
    rows += [(20, None), (21, ""), (22, "one line"), (None, "All rights are reserved here by law\n" + prose(30))]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS at", "2 AS gone_at")
    out = {r.doc_id: r for r in line_templates.dedup(table, least=10, dropped="n").collect()}
    assert out[0].text == rows[0][1] and out[0].n == 0
    for i in range(1, 12):
        lines = rows[i][1].split("\n")
        assert out[i].text == "\n".join([lines[0], lines[2]])
    assert out[None].text == rows[-1][1].split("\n")[1]
    assert (out[20].text, out[21].text, out[22].text) == (None, "", "one line")
    assert line_templates.dedup(empty).count() == 0


def test_copies_as_a_whole_are_left_to_other_stages(spark):
    table = spark.createDataFrame([(i, BASE + "\n" + SHARED) for i in range(15)], "doc_id long, text string")
    assert line_templates.dedup(table).where("text = ''").count() == 0


def test_mostly_recurring_documents_lose_their_lines(spark):
    """60 shared words and 40 of its own: only the first document keeps the shared ones; exact copies stay equal."""
    own = [prose(40) for _ in range(12)]
    rows = [(i, SHARED + "\n" + own[i]) for i in range(12)] + [(50, SHARED + "\n" + own[3]), (None, SHARED + "\n" + own[0])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_templates.dedup(table).collect()}
    assert out == {i: rows[0][1] if i in (0, None) else own[3 if i == 50 else i] for i, _ in rows}


def test_long_lines_recur_from_two_documents_on(spark):
    """Word for word only: another number in a long line makes another line; short lines still need ``least`` documents."""
    long, short = prose(49) + " 1", prose(49)
    rows = [(1, f"{prose(30)}\n{long}\n{short}"), (2, f"{prose(30)}\n{long}\n{short}"), (3, f"{prose(30)}\n{long[:-1]}2\n{short}")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_templates.dedup(table).collect()}
    assert out == {1: rows[0][1], 2: rows[1][1].replace(long + "\n", ""), 3: rows[2][1]}


def test_archives_round_trip(spark):
    rows = [(3, "u", "<p>x</p>"), (1, None, None), (2, "a b\nc", ""), (7, "é", "<p>x</p>"), (9, "u", "q\r\n\r\nWARC/1.0\r\n\r\né\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS path", "2 AS content")
    out = {r.page_id: r for r in arc.round_trip(pages, per_file=2).collect()}
    assert len(out) == 5 and all(r.payload_ok for r in out.values())
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "")]
        r = out[page_id]
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert (r.record_type, r.refers_to) == (("response", None) if page_id == min(same) else ("revisit", min(same)))
    assert arc.round_trip(pages.where("false")).count() == 0


def test_arc_lengths_are_checked():
    with pytest.raises(ValueError):
        list(arc.arc_records(b"http://x 0.0.0.0 2020 text/html 50\nshort"))
    with pytest.raises(ValueError):
        list(arc.arc_records(b"http://x 0.0.0.0 text/html 5\nshort"))


def test_broken_records_are_set_aside(spark, tmp_path):
    """Blanks in a content type, a declared field list, a record cut short, a broken header, a gzip file that ends early."""
    import gzip

    def header(url, kind, n, more=""):
        return f"{url} 1.2.3.4 20010203040506 {kind} {more}{n}\n".encode()

    one = header("http://a/", "text/html; charset=utf-8", 5) + b"hello\n"
    names = "URL IP-address Archive-date Content-type Checksum Archive-length"
    desc = f"1 0 Own\n{names}\n".encode()
    own = header("filedesc://own.arc", "text/plain", len(desc)) + desc + header("http://b/", "image/x y", 2, "abc ") + b"hi\n"
    broken = header("http://c/", "text/html", 3) + b"abc\nno header here\n" + header("http://d/", "text/html", 1) + b"d\n"
    cut = one + header("http://e/", "text/html", 500) + b"short\n" + header("http://f/", "text/html", 1) + b"f\n"
    files = {"a.arc": one, "b.arc": own, "c.arc": broken, "d.arc": cut, "e.arc.gz": gzip.compress(one) + gzip.compress(cut)[:-20], "f.arc": b""}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    found = collections.Counter((r.url, r.payload_bytes) for r in arc.read_arc(spark, str(tmp_path)).collect())
    for one_of in ("http://b/", 2), ("http://c/", 3), ("http://d/", 1):
        assert found[one_of] == 1
    assert found["http://a/", 5] >= 3 and found["http://f/", 1] >= 1 and len(found) == 5
    aside = sorted((r.path.rsplit("/", 1)[1], r.offset, r.reason.split(":")[0]) for r in arc.broken_arc(spark, str(tmp_path)).collect())
    assert aside[:2] == [("c.arc", len(header("http://c/", "text/html", 3)) + 4, "header of 3 fields, 5 declared"),
                         ("d.arc", len(one), "record is cut short")]
    assert any(f == "e.arc.gz" and why == "gzip" for f, _, why in aside)
    assert {r.record_type for r in arc.read_warc(spark, arc.convert(spark, str(tmp_path))).collect()} == {"response", "revisit"}


def ids_of(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.vocabulary())
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_pieces_are_those_of_the_library():
    chars = [*" \n\t\r\x0b\x0c\x1c abcXYZ'sreld09!?_-", *map(chr, (0x85, 0xA0, 0x2003, 0x3000, 0xE9, 0xDF, 0x4E2D, 0x1F600))]
    texts = ["".join(random.choices(chars, k=random.randrange(60))) + random.choice(["", "<|endoftext|>", " it's we'll"]) for _ in range(3000)]
    assert [i.tolist() for i in tokens.Encoder(tokens.vocabulary()).ids(texts)] == ids_of(texts)


def test_token_counts(spark, docs, empty):
    expected = {(i, len((t or "").encode())): len(x) for i, (t, x) in enumerate(zip(TEXTS + [BASE], ids_of(TEXTS + [BASE])))}
    out = tokens.token_counts(docs, chunk=500, overlap=16).collect()  # many chunks, and overlaps that must widen
    assert len(out) == docs.count()
    for r in out:
        assert r.n_tokens == expected[r.doc_id, r.n_bytes] and r.over_limit == (r.n_tokens > 1024)
    assert tokens.token_counts(empty).count() == 0


def test_packing(docs, empty):
    out = packing.pack(docs, shard=8).collect()
    sequences = collections.defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 2048 or at & (at - 1) == 0
    expected = collections.Counter()
    for r in docs.collect():
        expected[r.doc_id] += 1
    ids = dict(enumerate(ids_of(TEXTS + [BASE])))
    seen = collections.Counter()
    for r in out:
        whole = np.array([*ids[r.doc_id], 1], "<u4")
        assert r.doc_tokens == len(whole)
        assert r.ids_crc32 == zlib.crc32(whole[r.start : r.start + r.length].tobytes())
        seen[r.doc_id] += r.length
    assert seen == {d: n * (len(ids[d]) + 1) for d, n in expected.items()}
    assert packing.pack(empty).count() == 0


def test_neighbours_may_share_only_light_terms():
    """Twenty terms of the seed are weightier than those that it shares with its neighbour."""
    common = np.arange(5, 10)
    ids = [np.append(np.arange(100, 120), common), np.arange(200, 225), np.append(np.arange(300, 320), common)]
    terms, counts = np.unique(np.concatenate(ids), return_counts=True)
    packer = packing.Packer(packing.Weights(3, 25.0, terms, counts), 50, 0)
    packer.shard([(i, 0, x.astype("<u4"), 25) for i, x in enumerate(ids)])
    assert [r[0] for r in packer.rows] == [0, 2]


def test_repeated_bytes(spark, docs, empty):
    more = docs.union(spark.createDataFrame([(30, "a" * 120, *[None] * 6), (31, "a" * 70 + "b", *[None] * 6)], SCHEMA))
    rows = [(r.doc_id, (r.text or "").encode()) for r in more.collect()]
    first = {}
    for d, b in rows:
        for i in range(len(b) - 49):
            first[b[i : i + 50]] = min(first.get(b[i : i + 50], d), d)
    expected = {}
    for d, b in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        expected[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    out = suffix_dedup.report(more).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == expected
    assert suffix_dedup.report(empty).count() == 0


def test_texts_with_one_id_or_none_keep_their_own_bytes(spark):
    """Two texts without an id whose CRC-32 is equal: only the one that an earlier document has goes."""
    made, seen = random.Random(11), {}
    while True:
        text = "".join(made.choices("abcdefgh", k=80))
        other = seen.setdefault(zlib.crc32(text.encode()), text)
        if other != text:
            break
    rows = [(1, text), (None, text), (None, other), (2, other[::-1]), (2, text), (2, prose(30))]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = collections.Counter((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.report(table).collect())
    last = len(rows[-1][1])
    assert out == collections.Counter([(1, 80, 0), (None, 80, 80), (None, 80, 0), (2, 80, 0), (2, 80, 80), (2, last, 0)])


def fingerprint(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_of(prints):
    root = {i: i for i, _ in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in prints:
        for j, b in prints:
            if (a ^ b).bit_count() <= 2:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in prints}


def test_simhash_classes(docs, empty):
    prints = sorted({(r.doc_id, fingerprint(r.text)) for r in docs.collect()})
    expected, out = classes_of(prints), simhash.report(docs).collect()
    assert len(out) == docs.count()
    assert {(r.doc_id, r.fingerprint) for r in out} == {(i, f"{p:016x}") for i, p in prints}
    assert {r.doc_id: r.component_id for r in out} == expected
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))
    assert simhash.report(empty).count() == 0


def test_one_of_each_with_repeated_and_missing_ids(spark):
    """Unlinked texts all stay, with one id or none; a row without an id goes where its class has another."""
    texts = [prose(80) for _ in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[4]), (None, texts[4]), (9, texts[5]), (9, texts[5]),
            (7, texts[4]), (None, texts[0])]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    key = lambda r: (r[0] or 0, r[1])
    out = sorted(map(tuple, simhash.one_of_each(table).collect()), key=key)
    assert out == sorted([*rows[:4], (9, texts[5]), (7, texts[4])], key=key)


def test_links_of_dense_sets_lose_nothing(spark):
    """Sets larger than a block are refined and then compared in blocks."""
    base = random.getrandbits(64)
    prints = {base ^ (1 << random.randrange(12)) ^ (1 << random.randrange(12)) ^ (1 << random.randrange(40)) for _ in range(500)}
    prints |= {random.getrandbits(64) for _ in range(200)}
    rows = list(enumerate(sorted(prints)))
    signed = [(p - (1 << 64) if p >> 63 else p,) for _, p in rows]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), block=16).collect()
    found = [{*pair} for pair in {(r.a % 2**64, r.b % 2**64) for r in links}]
    assert all((a ^ b).bit_count() <= 2 for a, b in found)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in found:
        root[find(a)] = find(b)
    classes = collections.defaultdict(set)
    for i, c in classes_of(rows).items():
        classes[c].add(rows[i][1])
    assert all(len({find(p) for p in members}) == 1 for members in classes.values())


def test_thresholds_follow_the_pigeonhole():
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2, (2000, 64)).astype(float)
    both = bits.T @ bits
    for parts in (1, 2, 3, 4):
        groups = simhash.deal_bits(2000, both, parts)
        assert sorted(b for g in groups for b in g) == list(range(64))
        assert sum(simhash.allocate(2000, both, groups, 2)[1]) == 2 - parts + 1


def test_sets_cut_by_batches_lose_nothing():
    """Sets that go on in the next batch, or in the next three, are compared whole; links are a forest of near members."""
    rng = random.Random(3)
    rows = []
    for value, n in enumerate([1, 2, 5, 1, 40, 3, 90, 1]):
        base = rng.getrandbits(62)
        rows += [(base ^ (1 << rng.randrange(9)) ^ (1 << rng.randrange(60)), 1 + value // 4, value) for _ in range(n)]
    frame = pd.DataFrame(rows, columns=["fp", "mask", "value"])

    def parts(links, members):
        left = {m: {m} for m in members}
        for a, b in links:
            if left[a] is not left[b]:
                joined = left[a] | left[b]
                left.update(dict.fromkeys(joined, joined))
        return {frozenset(s) for s in left.values()}

    for size in (1, 7, 30, len(frame)):
        batches = [frame.iloc[i : i + size].reset_index(drop=True) for i in range(0, len(frame), size)]
        out = pd.concat(list(simhash._sets(["mask", "value"], 2)(iter(batches))))
        found = list(zip(out["a"].tolist(), out["b"].tolist()))
        assert len(found) < len(frame) and all((a ^ b).bit_count() <= 2 for a, b in found)
        for _, members in frame.groupby("value"):
            fps = members["fp"].tolist()
            plain = [(a, b) for a in fps for b in fps if (a ^ b).bit_count() <= 2]
            assert parts([x for x in found if x[0] in fps], fps) == parts(plain, fps)
    assert list(simhash._sets(["mask", "value"], 2)(iter([]))) == []


def test_ranges_are_refined_until_the_cuts_are_exact(spark):
    """Digests that share their first digits, equal sizes, one group with a third of all bytes: the ends of a plain greedy search."""
    rng = random.Random(9)
    for huge in (0, 900):
        groups = {"abcd" + rng.choice(["0000", "00ff", f"{rng.randrange(16**4):04x}"]) + f"{rng.randrange(16**8):08x}": rng.choice([1, 7, 7, 30])
                  for _ in range(150)}
        groups |= {f"{rng.randrange(16**16):016x}": rng.randrange(1, 40) for _ in range(20)}
        if huge:
            groups["abcd00ff" + "8" * 8] = huge
        table = spark.createDataFrame(list(groups.items()), "digest string, size long").coalesce(2).persist()
        ordered = [groups[d] for d in sorted(groups)]
        for shards in (1, 2, 5, 8):
            def plain(capacity):
                ends, at, room = [], 0, capacity
                for size in ordered:
                    if size > room:
                        ends, room = [*ends, at], capacity
                    at, room = at + size, room - size
                return [*ends, at]

            best = next(c for c in range(max(ordered), sum(ordered) + 1) if len(plain(c)) <= shards)
            assert sharding.minimax(sharding.Sizes(table), shards) == (best, plain(best))


def test_minimax_shards(docs, empty):
    out = sharding.assign(docs, shards=3).collect()
    rows = [((r.text or "").encode(), r.doc_id) for r in docs.collect()]
    groups = collections.Counter()
    for b, _ in rows:
        groups[hashlib.sha256(b).hexdigest()] += len(b) + 1
    sizes = [groups[d] for d in sorted(groups)]

    def fits(capacity):
        shards, room = 1, capacity
        for s in sizes:
            if s > room:
                shards, room = shards + 1, capacity
            room -= s
            if room < 0:
                return False
        return shards <= 3

    best = next(c for c in range(max(sizes), sum(sizes) + 1) if fits(c))
    loads = collections.Counter()
    slots = collections.defaultdict(list)
    for r in out:
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert len(out) == len(rows) and max(loads.values()) == best
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign(empty).count() == 0


def test_toxicity_on_held_out_rows(spark):
    rows, marks = [], []
    for i in range(900):
        bad = i % 4 == 0
        rows.append((i, prose(40) + (" you vile worm " if bad else " ") + prose(20)))
        marks.append((i, int(bad)))
    rows += [(2000, None), (2001, ""), (2002, ""), (2002, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS toxic")
    labels = spark.createDataFrame(marks + [(None, 1), (5, None)], "doc_id long, toxic int").selectExpr("*", "1 AS text")
    out = {r.doc_id: r for r in toxicity.report(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in out.items())
    held = [(out[i].score, y) for i, y in marks if out[i].held_out]
    right = [(s > 0.5) == bool(y) for s, y in held]
    assert sum(right) / len(right) > 0.95
    assert out[2000].score == out[2001].score == out[2002].score
    assert toxicity.report(docs, labels.where("false")).where("score <> 0.5").count() == 0
    assert toxicity.report(docs.where("false"), labels).count() == 0


def test_spaced_seeds(spark, docs):
    item, other = prose(40).split(), prose(30).split()
    changed = list(item)
    for at in (7, 16, 25, 34):
        changed[at] = "changed"
    rows = [(0, prose(50) + " " + " ".join(item) + " " + prose(5)), (1, " ".join(changed).upper()), (2, prose(200)), (3, None), (4, ""),
            (5, " ".join(item[:10]) + " " + prose(60)), (6, "start " + " ".join(other[:20])), (6, " ".join(other))]
    table = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS item_id")
    bench = spark.createDataFrame([(10, " ".join(item)), (11, " ".join(other)), (12, None), (13, ""), (14, "tiny zebra set")],
                                  "item_id long, text string").selectExpr("*", "1 AS doc_id")
    out = {(r.doc_id, r.item_id): r for r in decontaminate.report(table, bench).collect()}
    assert set(out) == {(0, 10), (1, 10), (6, 11)}
    assert (out[0, 10].n_equal, out[1, 10].n_equal, out[6, 11].n_equal) == (40, 36, 30)
    assert {r.doc_id for r in decontaminate.clean(table, bench).collect()} == {2, 3, 4, 5}
    blocks = decontaminate.overlaps(table, bench, block=1).select("doc_id", "item_id").distinct().collect()
    assert {tuple(r) for r in blocks} == set(out)
    assert decontaminate.report(table, bench.where("false")).count() == 0


def test_overlaps_with_insertions_and_of_long_parts(spark):
    """A word inserted or removed moves the rest to another offset; half of a long item is an overlap too."""
    a, long = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(200)]
    texts = {1: a[:20] + ["new"] + a[20:], 2: a[:13] + ["new"] + a[13:27] + ["new"] + a[27:], 3: a[:20] + a[21:],
             4: ["x"] * 9 + long[:100], 5: a[:20], 6: long[:40], 7: a[:12] + ["x"] * 50 + a[28:]}
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(long))], "item_id long, text string")
    out = {(r.doc_id, r.item_id): (r.start, r.n_equal) for r in decontaminate.report(table, bench).collect()}
    assert out == {(1, 1): (0, 40), (2, 1): (14, 40), (3, 1): (0, 39), (4, 2): (9, 100), (7, 1): (0, 24)}


def test_two_substitutions_in_a_short_item_are_found():
    hashes = decontaminate.Hashes()
    for n in (12, 13, 15, 18, 19, 23):
        words = [f"w{i}" for i in range(n)]
        index = decontaminate.Index([(1, hashes(" ".join(words)))])
        for a in range(n):
            for b in range(a, n):
                changed = " ".join("other" if i in (a, b) else w for i, w in enumerate(words))
                assert 0 in index.overlaps(hashes("before " + changed + " after")), (n, a, b)


def test_contaminated_rows_go_whatever_their_id(spark):
    item = [f"i{k}" for k in range(30)]
    rows = [(None, " ".join(item)), (None, prose(40)), (2**60 + 1, " ".join(item)), (2**60 + 1, prose(40)), (None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {tuple(r) for r in decontaminate.clean(table, bench).collect()} == {rows[1], rows[3], rows[4]}


def test_pipeline_keeps_what_it_should(spark):
    kept = corpus_pipeline.run(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert kept.columns == packing.NAMES
    good = quality.kept(docs)
    ids = {r.doc_id for r in kept.select("doc_id").distinct().collect()}
    cleaned = line_templates.dedup(good)
    single = simhash.one_of_each(cleaned)
    dirty = {r.doc_id for r in decontaminate.report(single, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()}
    assert ids == {r.doc_id for r in single.collect()} - dirty
    prints = [(r.doc_id, fingerprint(r.text)) for r in cleaned.collect()]
    assert {r.doc_id for r in single.collect()} == set(classes_of(prints).values())


def test_registered():
    names = entry_point.queries()
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names}
