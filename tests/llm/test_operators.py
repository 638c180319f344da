"""Each operator against brute force on a small table with all odd cases at once, and on empty tables."""

import collections
import itertools
import json
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapack.llm import decontamination, extraction, jaccard, knn, lines, mixing, quality, secrets, sharding, suffixes, words

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, size string, items string, spans int, copies int, x int, rate string, target int, source_size double, kept int, n int"


def rows():
    random.seed(11)
    vocabulary = ["".join(random.choices("abcdefghij", k=random.randrange(2, 9))) for _ in range(300)]
    base = [" ".join(random.choices(vocabulary, k=random.randrange(1, 160))) for _ in range(30)]
    texts = [None, "", " \n\t", "one", "\n\n", *base, *base[:6], *base[:2], *base[:1]]
    for t in base[:14]:  # near copies, and passages that are shared
        w = t.split(" ")
        for k in range(len(w) // 30):
            w[random.randrange(len(w))] = "zz"
        texts.append(" ".join(w))
        texts.append("begin " + t + "\nshared line of text\n" + random.choice(base))
    texts += ["password = hunter22x and AKIA" + "Q" * 16 + " " + "0a" * 14, "SECRET: 'abc' token :abcdefg", "ghp_" + "a1" * 18, "é token=ééé api-key=abcdef apikey=abc.def"]
    texts.append(" ".join(random.choices(vocabulary, k=20_000)))
    texts += ["spam spam " * 300, "Shared Line of text"] + ["x\nShared line OF text \ny"] * 3
    out = [(k, t, "en", f"s{k % 5}" if k % 7 else None, None, 0.5, 3, "9", "i", 1, 2, None, "r", 4, 0.25, 1, 7) for k, t in enumerate(texts)]
    out.append((None, base[3], *[None] * 15))
    out.append((None, None, *[None] * 15))
    out += [out[7], out[7], out[9]]  # repeated rows
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def plain(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", plain(text))


def shingle_set(text, n):
    w = split_words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def test_sharding(spark, docs, none):
    got = sharding.shard_documents(docs, 7).collect()
    assert len(got) == len(rows())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted((d[0] is None, d[0] or 0, len((d[1] or "").encode()) + 16, zlib.crc32((d[1] or "").encode())) for d in rows())
    shards = collections.defaultdict(list)
    homes = collections.defaultdict(set)
    for r in got:
        shards[r.shard].append(r.slot)
        homes[r.text_crc32, r.size].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in shards.values()) and set(shards) <= set(range(7))
    assert all(len(h) <= (2 if size == 16 else 1) for (_, size), h in homes.items())  # null and empty texts are two groups
    load = collections.Counter()
    for r in got:
        load[r.shard] += r.size
    groups = collections.Counter()
    for d in rows():
        groups[d[1]] += len((d[1] or "").encode()) + 16
    assert load == greedy(groups.values(), 7)
    assert sharding.shard_documents(none, 7).count() == 0


def greedy(sizes, shards):
    load = collections.Counter()
    for size in sorted(sizes, reverse=True):
        load[min(range(shards), key=lambda k: (load[k], k))] += size
    return +load


def test_schedule_is_the_greedy_one(monkeypatch):
    rng = random.Random(2)
    for by_one in (0, 1, 4):
        monkeypatch.setattr(sharding, "BY_ONE", by_one)
        for shards in (1, 3, 7):
            sizes = [rng.randrange(1, 9) ** rng.randrange(1, 4) for _ in range(rng.randrange(300))] + [5] * 100
            plan, load = sharding.Schedule(shards), collections.Counter()
            for size, n in sorted(collections.Counter(sizes).items(), reverse=True):
                took = plan.place(size, n)
                assert sum(took) == n
                load.update({k: size * c for k, c in enumerate(took)})
            assert +load == greedy(sizes, shards)


def test_many_copies_keep_together_and_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SIZES_AT_ONCE", 3)
    texts = ["the same text"] * 300 + [f"text {k}" for k in range(90)] + [None] * 30
    got = sharding.shard_documents(spark.createDataFrame([(None if k % 5 == 0 else 1, t) for k, t in enumerate(texts)], "doc_id long, text string"), 5).collect()
    assert len(got) == len(texts) and len({r.shard for r in got if r["size"] == 29}) == 1
    for k in range(5):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))


def test_mixing(spark, docs, none):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows())
    sizes = collections.Counter()
    for d in rows():
        sizes[d[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", d[1] or ""))
    order = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if 3 * sizes[s] <= level * weight[s]}
        for s in over or free:
            target[s] = 3.0 * sizes[s] if over else level * weight[s]
        if not over:
            break
        left -= sum(target[s] for s in over)
        free -= over
    taken = collections.Counter()
    for r in got:
        assert 0 <= r.copies <= 3 and r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) < 1e-6
        taken[r.source] += r.copies * int(r["size"])
    largest = {s: max(len((d[1] or "").split()) for d in rows() if d[3] == s) for s in order}
    for s in order:
        assert abs(taken[s] - target[s]) <= max(0.02 * target[s], largest[s])
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix(none).count() == 0
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)
    assert {(r.rate, r.target, r.source_size, r["size"], r.copies) for r in out.collect()} <= {("r", 4, 0.25, "9", 2), (None,) * 5}


def test_tilts_meet_their_targets(spark):
    cells = spark.createDataFrame([("a", s, n) for s, n in ((1, 50), (10, 20), (500, 3), (7000, 1))] + [("b", 5, 100), ("b", 50, 10)], "source string, size long, n long")
    sizes = {"a": 50 + 200 + 1500 + 7000, "b": 1000}
    targets = spark.createDataFrame([("a", sizes["a"], 74, 1.0, False, 4000.0), ("b", sizes["b"], 110, 2.0, False, 2500.0)], "source string, source_size long, source_n long, weight double, capped boolean, target double")
    for r in mixing.solve_tilts(cells, targets).collect():
        words_ = sum(s * n * min(3.0, np.exp(r.tilt * s / r["mean"])) for q, s, n in ((c.source, c["size"], c.n) for c in cells.collect()) if q == r.source)
        assert abs(words_ - r.target) < 1e-3 * r.target


def test_line_dedup(spark, docs, none):
    strip = " \t\n\x0b\x0c\r"
    for least in (2, 4):
        count = collections.Counter()
        for d in rows():
            count.update({plain(x.strip(strip)) for x in (d[1] or "").split("\n")} - {""})
        want = []
        for d in rows():
            all_ = (d[1] or "").split("\n")
            kept = [x for x in all_ if not plain(x.strip(strip)) or count[plain(x.strip(strip))] < least]
            want.append((d[0], len(all_), len(all_) - len(kept), "\n".join(kept)))
        got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in lines.dedup_lines(docs, least).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert lines.dedup_lines(none).count() == 0


@pytest.mark.parametrize(("n", "num"), [(4, 85), (5, 80), (3, 50)])
def test_jaccard_join(spark, docs, none, n, num):
    data = rows()
    sets = [shingle_set(d[1], n) for d in data]
    root = list(range(len(data)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = collections.Counter()
    for a, b in itertools.combinations(range(len(data)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            links.update((a, b))
            root[find(a)] = find(b)
    want = []
    for k, d in enumerate(data):
        ids = [e[0] for i, e in enumerate(data) if find(i) == find(k) and e[0] is not None]
        want.append((d[0], len(sets[k]), min(ids) if ids and sets[k] else d[0], links[k]))
    got = [(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in jaccard.join(docs, n, num, 100).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    if n == 5:
        kept = jaccard.keep_one(docs, n, num, 100)
        assert kept.columns == docs.columns
        left = kept.collect()
        assert len(left) == len({find(k) for k in range(len(data)) if sets[k]}) + sum(not s for s in sets)
        assert jaccard.join(none, n, num, 100).count() == 0 and jaccard.keep_one(none).count() == 0


def test_jaccard_large_groups(spark, monkeypatch):
    """Common shingles, their cells and families of several chunks, at small limits."""
    random.seed(5)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(150):
        w = list(base)
        for _ in range(k % 7):
            w[random.randrange(len(w))] = f"q{random.randrange(1000)}"
        texts.append(" ".join(w))
    texts += [" ".join(["shared passage of some words here"] + [f"r{k}_{j}" for j in range(40)]) for k in range(60)]
    monkeypatch.setattr(jaccard, "PROBE", 1)
    monkeypatch.setattr(jaccard, "COMMON", 5)
    monkeypatch.setattr(jaccard, "CELL", 16)
    monkeypatch.setattr(jaccard, "CHUNK", 20)
    monkeypatch.setattr(jaccard, "PAIR_CHUNK", 20)
    monkeypatch.setattr(jaccard, "LEADERS", 2)
    monkeypatch.setattr(jaccard, "BATCH", 200)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.component_id, r.n_links) for r in jaccard.join(df, 4, 85, 100).collect()}
    classes = {r.doc_id: r.component_id for r in jaccard.join(df, 4, 85, 100, count_links=False).collect()}
    assert classes == {k: v[0] for k, v in got.items()}
    sets = [shingle_set(t, 4) for t in texts]
    near = {k: [j for j in range(len(texts)) if j != k and 100 * len(sets[k] & sets[j]) >= 85 * len(sets[k] | sets[j])] for k in range(len(texts))}
    assert {k: len(v) for k, v in near.items()} == {k: v[1] for k, v in got.items()}
    for k in near:
        seen, todo = {k}, [k]
        while todo:
            todo += [j for j in near[todo.pop()] if j not in seen and not seen.add(j)]
        assert got[k][0] == min(seen)


def test_tree_passes_over_no_partner():
    rng = np.random.default_rng(9)
    base = [np.unique(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in (5, 40, 300, 3000) for _ in range(6)]
    sets = base + [np.unique(np.concatenate([b[: int(len(b) * f)], rng.integers(0, 2**64, 1 + len(b) // 20, dtype=np.uint64)])) for b in base for f in (1, 0.95, 0.7)]
    n, limit = np.array([len(s) for s in sets]), jaccard.Threshold(80, 100)
    tree = jaccard.Tree(jaccard.Points([jaccard.point(s) for s in sets]), n, np.arange(len(sets)))
    similar = jaccard.Exact(sets, limit)
    near = {k: {j for j in range(len(sets)) if 100 * len(np.intersect1d(sets[k], sets[j])) >= 80 * len(np.union1d(sets[k], sets[j]))} for k in range(len(sets))}
    for k in near:
        found = tree.near(k, limit)
        assert near[k] <= set(found.tolist()) and set(found[similar(k, found)].tolist()) == near[k]
    tree.take(np.arange(0, len(sets), 2))
    assert all(set(tree.near(k, limit).tolist()) >= {j for j in near[k] if j % 2} and not any(j % 2 == 0 for j in tree.near(k, limit).tolist()) for k in near)


def test_prefixes_share_one_order():
    tokens, counts = np.array([3, 5, 9, 20], np.uint64), np.array([7, 2, 9, 2])
    h = np.array([1, 3, 5, 8, 9, 20, 30], np.uint64)
    assert jaccard.first_in_order(h, 7, tokens, counts).tolist() == [1, 8, 30, 5, 20, 3, 9]
    assert jaccard.first_in_order(h, 2, tokens, counts).tolist() == [1, 8] and jaccard.first_in_order(h, 1, tokens, counts).tolist() == [1]
    assert jaccard.first_in_order(h, 3, tokens[:0], counts[:0]).tolist() == [1, 3, 5]


def test_rows_of_near_copies_grow_in_proportion(spark, monkeypatch):
    """Copies of one text that differ in a word: the rows that candidates and verified parts take follow their number."""
    made = {}
    read = jaccard.candidate_links, jaccard.verified
    counting = lambda f, name: lambda rows, *a: (made.setdefault(name, []).append(rows.count()), f(rows, *a))[1]
    for m in (400, 1200):
        made.clear()
        for f, name in zip(read, ("candidate_links", "verified"), strict=True):
            monkeypatch.setattr(jaccard, name, counting(f, name))
        random.seed(m)
        texts = []
        for k in range(m):
            w = [f"w{j}" for j in range(80)]
            w[random.randrange(80)] = f"q{k}"
            texts.append(" ".join(w))
        out = jaccard.join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), count_links=False)
        assert out.select("component_id").distinct().count() == 1
        assert sum(made["candidate_links"]) <= 25 * m and sum(made["verified"]) <= 1.2 * m


def test_words_and_shingles():
    of = words.Words()
    assert len(of(" a\x0bB\x85c d  ")) == 2 and len(of(None)) == 0
    assert of("A b")[0] == of("a")[0]
    h = of("a b c d e")
    assert len(words.shingles(h, 4)) == 2 and len(words.shingles(h[:2], 4)) == 1
    assert words.shingles(h, 4)[1] == words.shingles(h[1:], 4)[0]


def test_point_bounds_hold():
    rng = np.random.default_rng(2)
    for n in (3, 40, 700, 9000):
        a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: int(0.7 * n)], rng.integers(0, 2**64, n // 3, dtype=np.uint64)]))
        bound = jaccard.Points([jaccard.point(a), jaccard.point(b)]).bound(np.array([0]), np.array([1]))[0]
        assert len(np.intersect1d(a, b)) <= bound <= min(len(a), len(b)) + 4 * 255


def test_decontamination(spark, docs, none):
    texts = [d[1] for d in rows()]
    long = next(t for t in texts if t and 60 < len(t.split()) < 200)
    w = long.split()
    half = len(w) // 2
    bench = spark.createDataFrame([(1, long.upper()), (2, "no such words at all anywhere here"), (3, None), (4, "one two"), (5, "")], "item_id int, text string")
    more = spark.createDataFrame([(900, "x, " + " ".join(w[half:]) + "! and " + " ".join(w[:half])), (901, " ".join(w[: half // 2]))], "doc_id long, text string")
    got = decontamination.contaminated(more, bench).collect()
    assert [[i.item_id for i in r["items"]] for r in sorted(got)] == [[1], []]
    per_doc = []
    for per_pass in (10, 1_000_000):
        found = decontamination.contaminated(docs, bench, seeds_per_pass=per_pass)
        assert set(found.columns) == set(docs.columns)
        per_doc.append(sorted(((r.doc_id is None, r.doc_id or 0, sorted(tuple(i) for i in r["items"])) for r in found.collect())))
        hit = {r.doc_id for r in found.filter(F.size("items") > 0).collect()}
        assert {k for k, t in enumerate(texts[:-5]) if t == long} <= hit
        assert all(" ".join(w[:5]) in (texts[k] or "") or " ".join(w[-5:]) in (texts[k] or "") for k in hit if k is not None)
    assert per_doc[0] == per_doc[1]
    assert decontamination.contaminated(none, bench).count() == 0
    assert decontamination.contaminated(docs, bench.limit(0)).filter(F.size("items") > 0).count() == 0


def test_short_items_and_scripts_without_spaces(spark):
    bench = spark.createDataFrame([(1, "Four words, no more!"), (2, "Paris"), (3, "\u6c34\u306f\u4f55\u5ea6\u3067\u6cb8\u9a30\u3057\u307e\u3059\u304b"), (4, "???"), (5, "one two three four five six")], "item_id int, text string")
    texts = ["these four words no more here", "four words or no more", "paris", "\u554f: \u6c34\u306f\u4f55\u5ea6\u3067\u6cb8\u9a30\u3057\u307e\u3059\u304b\u3002\u7b54", "", "one two three four"]
    got = decontamination.contaminated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), bench).collect()
    assert [[i.item_id for i in r["items"]] for r in sorted(got)] == [[1], [], [2], [3], [], []]


def test_greedy_tiles_against_brute_force():
    random.seed(1)
    for _ in range(200):
        a, b = ([random.randrange(4) for _ in range(random.randrange(60))] for _ in range(2))
        cut = random.randrange(len(a) + 1)
        b = b[:10] + a[cut:] + b[10:20] + a[:cut]
        free_a, free_b, total = [True] * len(a), [True] * len(b), 0
        while True:
            best, found = 4, []
            for j, k in itertools.product(range(len(a)), range(len(b))):
                n = 0
                while j + n < len(a) and k + n < len(b) and free_a[j + n] and free_b[k + n] and a[j + n] == b[k + n]:
                    n += 1
                if n > best:
                    best, found = n, []
                if n == best and n > 4:
                    found.append((j, k))
            if not found:
                break
            for j, k in found:
                if all(free_a[j : j + best]) and all(free_b[k : k + best]):
                    free_a[j : j + best] = free_b[k : k + best] = [False] * best
                    total += best
        assert sum(t[2] for t in decontamination.greedy_tiles(np.array(a, np.uint64), np.array(b, np.uint64))) == total


def test_repeated_words_are_tiled_quickly():
    import time

    began = time.process_time()
    w = np.full(20_000, 7, np.uint64)
    assert sum(t[2] for t in decontamination.greedy_tiles(w[:200], w)) == 200
    two = np.tile(np.array([3, 4], np.uint64), 10_000)
    assert sum(t[2] for t in decontamination.greedy_tiles(two[:200], two[1:])) == 200
    assert time.process_time() - began < 2


def test_quality(spark, docs, none):
    data = [(k, ("good words in plain lines " * 3 if k % 2 else "BAD!! WORDS!! " * 5) + str(k)) for k in range(120)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in data] + [(None, 1), (5, None), (7, 1)], "doc_id long, quality int")
    got = quality.classify(spark.createDataFrame([*data, (None, None), (None, "x")], "doc_id long, text string"), labels).collect()
    assert len(got) == 122 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None)
    odd = [(1, "good words " * 100_000), (2, "good words " * 100_000), (2, "good words " * 100_000), (3, ""), (4, None), (5, " \n")]
    scores = [(r.doc_id, r.score, r.lang) for r in quality.classify(spark.createDataFrame([(*d, "x", 9.0, 3) for d in odd], "doc_id long, text string, lang string, good double, order int"), labels).collect()]
    assert len(scores) == 6 and len({s for i, s, _ in scores if i < 3}) == len({s for i, s, _ in scores if i > 2}) == 1 and {x for *_, x in scores} == {"x"}
    out = quality.classify(docs, labels.limit(0))
    assert out.count() == len(rows()) and out.select("score").distinct().count() == 1
    assert quality.classify(none, labels).count() == 0


PAGE = "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=x>m1</a></li><li>m2</li></ul></nav><div class='cookie-notice'>We use</div>{}<footer>f</footer></body></html>"


def test_extraction(spark):
    bodies = ["<article><h1>A &amp; B</h1><p>one <b>two</b><br>three<p>four&nbsp;five<script>var t='</p>';</script></p><div class=comments><p>no</p></div></article>", "<div><p>Menu same</p><p>text {}</p></div>".replace("{}", "uno"), "<div><p>Menu same</p><p>text dos</p></div>", "<div><p>Menu same</p><p>text tres</p></div>", "<main>x<form>f</form><aside>s</aside><table><tr><td>c1<td>c2</table></main>"]
    pages = [(k, f"http://h{int(k in (1, 2, 3))}.org/{k}", PAGE.replace("{}", b)) for k, b in enumerate(bodies)]
    pages += [(10, None, None), (11, "nothing", ""), (12, "http://z.org", "plain & simple <unclosed"), (None, "http://z.org", "<p>a</p><p>b" + "c" * 200_000), (0, *pages[0][1:])]
    got = {r.page_id: r for r in extraction.extract(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("text", F.lit(3))).collect()}
    assert got[0].text == "A & B\none two three\nfour five"
    assert got[4].text == "x\nc1\nc2" and got[10].text == got[11].text == "" and got[12].text == "plain & simple"
    assert [got[k].text.endswith(t) for k, t in ((1, "text uno"), (2, "text dos"), (3, "text tres"))] == [True] * 3
    assert got[None].n_chars == 200_003 and all(r.n_chars == len(r.text) for r in got.values())
    assert extraction.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def texts_of(spark, bodies):
    """Main texts of pages of one host, in order."""
    pages = spark.createDataFrame([(k, f"http://one.org/{k}", f"<html><body>{b}</body></html>") for k, b in enumerate(bodies)], "page_id long, url string, html string")
    return [r.text for r in sorted(extraction.extract(pages).collect(), key=lambda r: r.page_id)]


def test_wrapper_decides_within_an_article(spark):
    bodies = [f"<article><p>story {w}</p><div class=box><p>Written by our staff</p></div></article>" for w in ("uno", "dos", "tres")]
    assert texts_of(spark, bodies) == ["story uno", "story dos", "story tres"]
    assert texts_of(spark, bodies[:1]) == ["story uno\nWritten by our staff"]


def test_template_texts_among_blocks(spark):
    pages = [f"<div><p>Menu same</p><p>text {w}</p></div><div class=end><p>Imprint</p><p>Contact</p><ul><li>one<li>two</ul></div>" for w in ("uno", "dos", "tres", "cuatro")]
    assert texts_of(spark, pages) == ["text uno", "text dos", "text tres", "text cuatro"]
    deviating = [*pages, "<div><p>Other menu</p><p>text seis</p></div>"]
    assert texts_of(spark, deviating) == ["text uno", "text dos", "text tres", "text cuatro", "Other menu\ntext seis"]
    rare = [f"<article><p>text {k}</p>" + "<p>a common saying</p>" * (k < 3) + "<p>* * *</p><p>* * *</p>" * (k == 3) + "</article>" for k in range(9)]
    assert texts_of(spark, rare)[2:4] == ["text 2\na common saying", "text 3\n* * *\n* * *"]


def test_wrapper_keeps_constants_and_folds_slots():
    tree = None
    for k in range(40):
        new = extraction.page_tree(extraction.blocks(f"<body><p>top</p><h2>t{k}</h2>" + "".join(f"<p>{k} {n}</p>" for n in range(k % 7)) + "<p>end</p></body>"))
        tree = new if tree is None else extraction.align(tree, new)
    tree = extraction.pruned(tree)
    assert [(n[0], n[1], n[2] is None, n[4]) for n in tree[2][0][2]] == [("#", "1", False, "p"), ("#", "1", True, "h2"), ("#", "*", True, "p"), ("#", "1", False, "p")]
    assert sorted(extraction.template_texts(tree)) == sorted(("body", "p", extraction.text_hash(t)) for t in ("top", "end"))


@pytest.mark.parametrize("outer", ["class='layout has-sidebar'", "class=no-sidebar", "id=page class='ad-free'", "class=sidebar", "data-id='menu'", "title='see id=menu'"])
def test_a_word_around_the_article_drops_nothing(outer):
    text = extraction.main_text(f"<body><nav>n</nav><div {outer}><article><p>the whole story</p></article></div></body>", set())
    assert text == "the whole story"


def test_names_are_read_as_a_whole(spark):
    parts = "<section id='side-effects'><p>s</p></section><section id='related-work'>r</section><div id='social-history'>h</div><div data-id='menu'>d</div><section id='notice'>n</section>"
    gone = "<div class='cookie-notice'>x</div><div class='commentList'>x</div><div role=complementary>x</div><div class='box related-posts'>x</div>"
    assert extraction.main_text(f"<article><h1>t</h1>{parts}{gone}</article>", set()) == "t\ns\nr\nh\nd\nn"
    pages = [f"<article><p>story {w}</p><section id=related><p>see {w}</p></section></article>" for w in ("uno", "dos", "tres")]
    assert texts_of(spark, pages) == ["story uno", "story dos", "story tres"] and texts_of(spark, pages[:1]) == ["story uno\nsee uno"]
    assert extraction.main_text("<div class=post>" + "long text " * 9 + "</div><div class=sidebar><article>card</article></div>", set()) == ("long text " * 9).strip()


def test_articles_that_are_not_the_main_text():
    post, cards = "<div class=post><h1>Title</h1><p>" + "long text " * 30 + "</p></div>", "".join(f"<article><h2>card {k}</h2>tease</article>" for k in range(40))
    want = "Title\n" + ("long text " * 30).strip()
    assert extraction.main_text(post + cards, set()) == want
    assert extraction.main_text(f"<article>{post}<article class='comment'><p>first!</p></article></article>", set()) == want
    assert extraction.main_text(post + "<article class='comment depth-1'>" + "reply " * 200 + "</article>", set()) == want
    assert extraction.main_text("<p>five words stand out here</p><main>short</main>", set()) == "five words stand out here\nshort"
    assert extraction.main_text("<p>by</p><article>one post</article><article>two posts</article>", set()) == "one post\ntwo posts"


@pytest.mark.parametrize(
    "gone", ["<p class='advert'>x</p>", "<p class='cookie-notice'>x</p>", "<li class='comment'><p>x</p><p>y</p></li>", "<h2 class='newsletter'>x</h2>", "<p role=navigation>x<p>", "<button>x</button>", "<button><span>x</span></button>", "<p><span class='ad'>x <b>y</b></span></p>", "<a class='share'>x</a>"]
)
def test_marks_on_any_element(gone):
    assert extraction.main_text(f"<article><p>one</p>{gone}<p>two</p></article>", set()) == "one\ntwo"


def test_marks_within_a_block(spark):
    assert extraction.main_text("<article><p>one <span class=ad>x<b>y</b><i>z</span> two <button>Copy</button></p><p>three<pre><span class='token comment'># why</span></pre><h2 id=search>Search</h2><span class=ad>q<p>r</p></span>s</article>", set()) == "one two\nthree\n# why\nSearch\ns"
    pages = [f"<article><p>story {w}</p><p id=sponsor>by {w}</p></article>" for w in ("uno", "dos", "tres")]
    assert texts_of(spark, pages) == ["story uno", "story dos", "story tres"] and texts_of(spark, pages[:1]) == ["story uno\nby uno"]


@pytest.mark.parametrize("tag", ["div", "blockquote", "article", "span class=ad", "b", "ul", "table", "div class=sidebar", "li", "p"])
def test_any_depth(tag):
    name, deep = tag.split()[0], 4000
    for page in (f"<{tag}>" * deep + "in" + f"</{name}>" * deep + "<p>after</p>", f"<{tag}>x" * deep, f"</{name}>" * deep + "a" + f"<{tag}></{name}x>" * deep + "<head>" * 2000):
        tree = extraction.page_tree(extraction.blocks(page))
        tree = extraction.pruned(extraction.align(tree, extraction.page_tree(extraction.blocks(page.replace("in", "on")))))
        extraction.template_texts(json.loads(json.dumps(tree)))
        if "class" not in tag and tag != "article":  # short articles yield to what is larger
            assert len(extraction.main_text(page, set()).replace("\n", "").replace(" ", "")) == sum(c in "inxa" for c in re.sub("<[^>]*>|after", "", page)) + 5 * ("after" in page)


def test_long_regions_align():
    pages = ["<body><p>top</p>" + "".join(f"<p>{k} {n}</p>" + "<h2>the same</h2>" * (n == 700) for n in range(1500)) + "<p>end</p></body>" for k in range(3)]
    trees = [extraction.page_tree(extraction.blocks(p)) for p in pages]
    tree = extraction.align(extraction.align(trees[0], trees[1]), trees[2])
    assert sorted(extraction.template_texts(extraction.pruned(tree))) == sorted((("body", "p", extraction.text_hash("top")), ("body", "h2", extraction.text_hash("the same")), ("body", "p", extraction.text_hash("end"))))


def test_alignment_against_brute_force():
    """The pairs of two short lists are worth as much as those of any common order."""
    rng = random.Random(3)
    for _ in range(150):
        x, y = ([["#", "1", h := rng.choice("ab"), 2, rng.choice("pq"), {h: 2}] if rng.random() < 0.7 else [rng.choice(("div", "ul")), "1", [], 1] for _ in range(rng.randrange(6))] for _ in range(2))
        fix = [False] * 6
        worth = lambda pairs: sum(extraction._meet(x[i], y[j], False) for i, j in pairs)  # noqa: E731, B023
        best = 0
        for n in range(min(len(x), len(y)) + 1):
            for a in itertools.combinations(range(len(x)), n):
                for b in itertools.combinations(range(len(y)), n):
                    if all(extraction._meet(x[i], y[j], False) for i, j in zip(a, b, strict=True)):
                        best = max(best, worth(zip(a, b, strict=True)))
        pairs = extraction._compared(x, y, fix[: len(x)], fix[: len(y)])
        assert worth(pairs) == best and pairs == sorted(pairs)


def test_wrappers_align():
    a = extraction.page_tree(extraction.blocks("<body><nav>x</nav><div><p>one</p></div></body>"))
    b = extraction.page_tree(extraction.blocks("<body><nav>x</nav><section>new</section><div><p>two</p><p>three</p></div></body>"))
    body = extraction.align(a, b)[2][0]
    assert [(n[0], n[1]) for n in body[2]] == [("nav", "1"), ("section", "?"), ("div", "1")]
    assert body[2][2][2][0][:3] == ["#", "+", None]
    assert body[2][0][2][0][3] == 2


def test_secrets(spark, docs, none):
    def spans(text):
        out = []
        for rank, rule in enumerate(secrets.RULES):
            out += [(m.start(), rank, m.end()) for m in re.finditer(rule.pattern, text or "", re.ASCII) if len(m[rule.group]) >= rule.least]
        return sorted(out)

    want = sorted(((d[0], spans(d[1])) for d in rows()), key=repr)
    got = sorted(((r.doc_id, [(s.start, s.rank, s.end) for s in r.spans]) for r in secrets.scan(docs).collect()), key=repr)
    assert got == want and any(s for _, s in got)
    assert secrets.scan(none).count() == 0


@pytest.mark.parametrize("rule", secrets.RULES, ids=lambda r: r.kind)
def test_trigram_queries_admit_all_matches(rule):
    query = secrets.trigram_query(rule.pattern)
    assert bool(query) == (rule.kind != "hex")
    samples = ["PassWord: abcdef", "passwd=abcdef", "Secret='abcdef'", "token abc", "api_key=1", "APIKEY: x", "AKIA1234567890", "-----BEGIN RSA PRIVATE KEY-----", "gho_" + "a" * 36, "0" * 30]
    for text in samples:
        if re.search(rule.pattern, text) and query:
            assert any(all(t in plain(text) for t in clause) for clause in query)


def test_top_k(spark):
    rng = np.random.default_rng(4)
    data = [(k, [float(x) for x in rng.normal(size=6)]) for k in range(300)]
    data += [(300 + k, data[0][1]) for k in range(40)]  # one very common vector
    data += [(400, None), (401, [1.0, None, 2.0, 0.0, 0.0, 0.0]), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (None, [1.0] * 6), (500, []), (600, [0.5, 0.5]), (200, data[200][1])]
    df = spark.createDataFrame(data, "vec_id long, e array<double>")
    clean = df.filter(knn.usable(F.col("e"))).select("vec_id", knn.grid(F.col("e")).alias("v"), *(F.lit("x").alias(c) for c in ("cell", "far", "block", "score", "rank", "query_id", "below")))
    vectors = [(k, [int(np.floor(1024 * x)) for x in v]) for k, v in data if k is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    got = collections.defaultdict(list)
    for r in knn.top_k(clean, F.col("vec_id") % 100 == 0, pivots=9, block_rows=32).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    queries = {k: v for k, v in vectors if k % 100 == 0}
    assert set(got) == set(queries)
    for q, v in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), k) for k, w in vectors if k != q)[:10]
        assert sorted(got[q]) == [(n + 1, k, -s) for n, (s, k) in enumerate(scores)]
    assert knn.top_k(clean.limit(0), F.lit(True)).count() == 0
    assert knn.top_k(clean.limit(3), F.lit(True)).count() == 6


def test_top_k_of_large_components(spark):
    rng = np.random.default_rng(6)
    vectors = [(k, [int(x) for x in rng.integers(2**28, 2**29, 5)]) for k in range(60)]
    got = collections.defaultdict(list)
    for r in knn.top_k(spark.createDataFrame(vectors, "vec_id long, v array<long>"), F.lit(True)).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    for q, v in vectors:
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), k) for k, w in vectors if k != q)[:10]
        assert sorted(got[q]) == [(n + 1, k, -s) for n, (s, k) in enumerate(scores)]


def repeats(texts, length):
    count = collections.Counter()
    for t in texts:
        count.update(t[s : s + length] for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if count[t[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        out.append((len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize(("length", "most"), [(200, 256), (200, 2), (64, 4)])
def test_suffix_dedup(spark, docs, none, length, most):
    data = [d for d in rows() if len(d[1] or "") < 50_000]
    want = [(d[0], *x) for d, x in zip(data, repeats([(d[1] or "").encode() for d in data], length), strict=True)]
    df = spark.createDataFrame(data, DOCS).repartition(3)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffixes.remove_repeats(df, length, most).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    if most == 256:
        assert suffixes.remove_repeats(none).count() == 0


def test_suffix_arrays():
    random.seed(3)
    for n in range(400):
        t = [random.randrange(1, 2 + n % 5) for _ in range(random.randrange(40))] * (1 + n % 3) + [0]
        assert suffixes.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def test_prints_stand_for_equal_strings(monkeypatch):
    monkeypatch.setattr(suffixes, "STRETCH", 300)
    rng = random.Random(8)
    text = bytes(rng.randrange(97, 101) for _ in range(2000))
    lows, highs, keys, places, sure = suffixes.Prints(64)(text)
    owner, starts = {}, []
    for k, lo in enumerate(lows.tolist()):
        for s in range(lo, highs[k] + 1):
            starts.append(s)
            owner.setdefault(text[s : s + 64], set()).add((int(keys[k]), int(places[k]) - s))
            assert s <= places[k] <= s + 64 - suffixes.PRINT
    assert all(len(v) == 1 for v in owner.values()) and starts == list(range(len(text) - 63)) and not sure


@pytest.mark.parametrize("period", [1, 2, 3, 7, 60])
def test_short_periods_are_one_piece(monkeypatch, period):
    monkeypatch.setattr(suffixes, "STRETCH", 500)
    rng = random.Random(period)
    unit = bytes(rng.randrange(97, 123) for _ in range(period))
    text = b"0123456789" * 20 + unit * (3000 // period) + bytes(rng.randrange(97, 123) for _ in range(300))
    lows, highs, _, places, sure = suffixes.Prints(200)(text)
    assert all(b <= p <= a + 200 - suffixes.PRINT for a, b, p in zip(lows.tolist(), highs.tolist(), places.tolist(), strict=True))
    covered = set()
    for a, b in [*zip(lows.tolist(), highs.tolist(), strict=True), *sure]:
        covered.update(range(a, b + 1))
    assert covered == set(range(len(text) - 199)) and len(lows) < 120
    strings = collections.Counter(text[s : s + 200] for s in range(len(text) - 199))
    assert all(strings[text[s : s + 200]] > 1 for a, b in sure for s in range(a, b + 1))


def test_long_runs_of_one_byte(spark):
    texts = ["a" * 3_000_000, "ab" * 1_000_000, "x" * 150 + "a" * 200 + "y" * 150, "q" + "ba" * 100 + "q", "a" * 201 + "z", "c" * 200]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffixes.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: (3_000_000, 1), 1: (2_000_000, 1), 2: (200, 1), 3: (200, 1), 4: (201, 1), 5: (0, 0)}
