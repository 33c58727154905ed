"""Periodic runs, URL rules and the filter audit against plain loops, and on odd rows."""

import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import values
from pyspark.sql import functions as F

from clickfolk.llm import periodic_runs as P
from clickfolk.llm import url_filters as U
from clickfolk.llm.filter_audit import audit, document_masks, document_term_matrix, row_sums
from clickfolk.llm.queries import op12_periodic_runs
from llm_cases import no_docs, odd_docs  # noqa: F401  fixtures


def plain_runs(words, shortest=6, exponent=4):
    """Every period in turn: stretches of equal words that far apart, without those of a smaller period."""
    found = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            smaller = any(all(words[k] == words[k + p] for k in range(start, start + length - p)) for p in range(1, q))
            if length >= max(shortest, exponent * q) and not smaller:
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {k for start, length, q in runs for k in range(start + q, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def periodic_texts(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        words = []
        while len(words) < rng.randint(0, 60):
            block = [rng.choice("abc") for _ in range(rng.randint(1, 5))]
            words += block * rng.randint(1, 7) + [rng.choice("abcdef") for _ in range(rng.randint(0, 3))]
            words = words[: len(words) - rng.randint(0, 2)]
        texts.append(words)
    return texts


@pytest.mark.parametrize("shortest,exponent", [(6, 4), (2, 2), (5, 3)])
def test_runs_equal_every_period_in_turn(shortest, exponent):
    texts = periodic_texts(exponent)
    numbers = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for t in texts for w in t], np.int32)
    ends = np.cumsum([0] + [len(t) for t in texts])
    found = P.runs_of(ids, ends, shortest, exponent).tolist()
    expected = [[start + a, length, q] for t, a in zip(texts, ends) for start, length, q in plain_runs(t, shortest, exponent)]
    assert found == expected and len(expected) > 20


def test_runs_of_long_equal_and_nested_texts():
    n = 60_000
    ids, ends = np.zeros(n, np.int32), np.array([0, n])
    assert P.runs_of(ids, ends, 6, 4).tolist() == [[0, n, 1]]
    # stretches of one word between different ones: large classes unite with small ones
    many = np.concatenate([np.append(np.zeros(k % 40 + 1, np.int32), k + 1) for k in range(2000)]).astype(np.int32)
    runs = P.runs_of(many, np.array([0, len(many)]), 6, 4)
    starts = np.cumsum([0] + [k % 40 + 2 for k in range(1999)])
    expected = [[int(s), k % 40 + 1, 1] for k, s in enumerate(starts) if k % 40 >= 5]
    assert [r for r in runs.tolist() if r[2] == 1] == expected


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_row(doc_id, text):
    words = [w for w in __import__("re").split("[ \t-\r]+", text or "") if w]
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), best[0], best[1], best[2], milli, digest("".join("%d,%d,%d\n" % r for r in runs)),
            digest(plain_collapsed(words, runs)))


def test_query_equals_the_plain_loop(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, " ".join(t)) for k, t in enumerate(periodic_texts(9))]
    rows += [(k, " ".join(rng.choice(["x", "y\tz", "é", "w1\n"]) for _ in range(rng.randint(1, 90)))) for k in range(100, 260)]
    rows += [(300, None), (301, ""), (302, " \n "), (303, "a b " * 9), (303, "a b " * 9), (-7, "q " * 30)]
    spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS runs", "1 AS row").write.parquet(
        str(tmp_path / "documents.parquet"))
    out = op12_periodic_runs(spark, str(tmp_path))
    assert values(out) == sorted([plain_row(*r) for r in rows], key=repr)
    assert out.where("n_runs > 0").count() > 40


def test_runs_on_odd_rows(spark, odd_docs, no_docs):
    out = P.periodic_runs(odd_docs)
    assert out.count() == odd_docs.count()
    assert P.periodic_runs(no_docs).count() == 0
    row = out.where("doc_id = 6").first()
    assert [tuple(r) for r in row["runs"]] == [(0, 12000, 3)] and row["collapsed"] == "lorem ipsum dolor #end"
    assert out.where("doc_id IS NULL").first()["runs"] == []
    with pytest.raises(ValueError):
        P.periodic_runs(odd_docs, exponent=1)
    null_id = odd_docs.where("doc_id IS NULL").select(P.planted(F.col("doc_id"), F.col("text")).alias("t")).first()["t"]
    assert null_id.startswith("no id")


# --- URL rules


def plain_judgement(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for mark in "/?#":
        host = host.split(mark, 1)[0]
    path = rest[len(host):]
    for mark in "?#":
        path = path.split(mark, 1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fitting = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    size, rule, verdict = max(fitting, default=(0, None, default))
    return host, path, rule, verdict


def random_rules(rng, n):
    hosts = ["net", "a.net", "b.a.net", "org", "x.org", "c"]
    paths = ["", "/", "/en/", "/en", "/en/deep/", "/e", "/fr/x", "//"]
    pairs = rng.sample(list(itertools.product(hosts, paths)), n)
    return [(h, p, rng.choice(["allow", "block"])) for h, p in pairs]


def random_urls(rng, n):
    hosts = ["net", "a.net", "z.b.a.net", "B.A.net", "xnet", "x.org", "y.x.org:80", "c", "", "q.c.", "u@c"]
    paths = ["", "/", "/en", "/en/", "/en/deep/er", "/end", "/fr/xyz", "//", "/EN/", "/é/"]
    tails = ["", "?q=/en/", "#/en/", "?a://b"]
    urls = [rng.choice(["http://", "https://", "://", "HTTP://"]) + rng.choice(hosts) + rng.choice(paths) + rng.choice(tails)
            for _ in range(n)]
    return urls + [None, "", "no scheme", "net/", "http:/net/", "http://", "a://b://c/", "x\ny://net/\nz"]


@pytest.mark.parametrize("settings", [{}, {"broadcast_rules": 0, "hot": 3}, {"broadcast_rules": 0}])
def test_rules_equal_a_plain_loop(spark, settings):
    rng = random.Random(len(settings))
    rules, urls = random_rules(rng, 30), random_urls(rng, 300)
    rows = list(enumerate(urls)) + [(5, urls[5]), (None, "http://a.net/en/"), (None, "http://a.net/en/"), (None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "'r' AS rule", "1 AS copies", "2 AS host")
    rule_rows = spark.createDataFrame(rules + [(None, "/", "block"), ("org", None, "block")], "host string, path string, verdict string")
    out = U.judge(pages, rule_rows, **settings)
    assert values(out) == sorted([(k, *plain_judgement(u, rules)) for k, u in rows], key=repr)
    assert out.where("rule IS NOT NULL").count() > 50


def test_rules_on_long_urls_and_empty_tables(spark):
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    long = "http://" + "a." * 50_000 + "net" + "/b" * 50_000
    pages = spark.createDataFrame([(1, long)], "page_id bigint, url string")
    row = U.judge(pages, rules).first()
    assert (row["rule"], row["verdict"], len(row["host"]), len(row["path"])) == ("net/", "block", 100_003, 100_000)
    assert U.judge(pages.limit(0), rules).count() == 0
    assert values(U.judge(pages, rules.limit(0), default="block").select("rule", "verdict")) == [(None, "block")]
    twice = spark.createDataFrame([(1, "http://net/")] * 9000, "page_id bigint, url string")
    assert U.judge(twice, rules).count() == 9000


def test_only_rules_bound_the_expressions(spark):
    made = spark.range(1).select(U.expressions(F.lit("a.b.c.net"), F.lit("/en/x/y"), 2, 4, [3]).alias("e")).first()["e"]
    assert sorted(made) == sorted([h + p for h in ("c.net", "net") for p in ("", "/", "/en/", "/en")])


# --- filter audit


def plain_audit(docs, labels):
    good = {d for d, q, t in labels if q == 1 and d is not None}
    bad = {d for d, q, t in labels if t == 1 and d is not None}
    least = {}
    for d, text, _ in docs:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    rows = []
    for d, text, part in docs:
        text = text or ""
        words = text.split()
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": any(c in "#$%&*|" for c in text),
                 "E": d is not None and least[text] < d}
        rows.append((part or "", {k for k, v in fails.items() if v}, d in good, d in bad))
    out, shapley = [], {}
    for part in {r[0] for r in rows}:
        for order in itertools.permutations("ABCDE"):
            for k, letter in enumerate(order):
                before = set(order[:k])
                mine = [r for r in rows if r[0] == part]
                here = [r for r in mine if letter in r[1] and not r[1] & before]
                shapley[part, letter] = shapley.get((part, letter), 0) + len(here)
                out.append([part, "".join(order), k + 1, sum(not r[1] & (before | {letter}) for r in mine), len(here),
                            sum(letter in r[1] and bool(r[1] & before) for r in mine), sum(r[1] == {letter} for r in mine),
                            sum(r[2] for r in here), sum(r[3] for r in here)])
    return sorted([tuple(r + [shapley[r[0], r[1][r[2] - 1]]]) for r in out], key=repr)


def audit_rows():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["one", "Two", "three3", "#x", "ÄÖ"][: rng.randint(1, 5)] + [str(k) for k in range(rng.choice([1, 400]))])
                      for _ in range(rng.choice([3, 150, 250]))) for _ in range(30)] + [None, "", " \n", "A", "a|b"]
    rows = [(k, rng.choice(texts), rng.choice(["s", "t", None, ""])) for k in range(120)]
    rows += [(3, "twice", "s"), (3, "twice", "s"), (3, "other", "t"), (None, "twice", "s"), (None, None, None), (-5, "A", "t")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 120, 2)] + [(3, 1, 0), (3, 0, 1), (None, 1, 1)]
    return rows, labels


def test_audit_equals_a_plain_loop(spark):
    rows, labels = audit_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "1 AS mask", "'x' AS part", "2 AS n")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").selectExpr("*", "true AS good", "1 AS mask")
    order = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert values(audit(docs, known), *order) == plain_audit(rows, labels)


def test_matrix_holds_the_counts_of_every_word(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text")
    matrix, dictionary = document_term_matrix(docs, F.col("doc_id"), F.col("text"), shard_bytes=2000, bucket_entries=20)
    assert matrix.count() > 1
    words = {r["word_id"]: bytes(r["word"]).decode() for r in dictionary.collect()}
    assert len(words) == dictionary.count() == len(set(words.values())) and max(words) < 40 * len(words)
    found = []
    for r in matrix.collect():
        for k, doc in enumerate(r["rows"]):
            a, b = r["begins"][k], r["begins"][k + 1]
            found.append((doc, sorted(zip((words[w] for w in r["words"][a:b]), r["counts"][a:b]))))
    expected = []
    for r in docs.collect():
        cut = (r["text"] or "").split()
        expected.append((r["doc_id"], sorted((w, cut.count(w)) for w in set(cut))))
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert values(row_sums(matrix)) == sorted([(d, sum(n for _, n in c), len(c)) for d, c in expected], key=repr)


def test_audit_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert audit(no_docs, labels).count() == 0
    out = audit(odd_docs, labels)
    assert out.count() == 2 * 120 * 5 and out.where("part = ''").count() == 600
    masks = {r["id"]: r["mask"] for r in document_masks(odd_docs).collect()}
    assert masks[6] & 1 == 0 and masks[6] & 2 and masks[6] & 8 and masks[4] & 16 and not masks[3] & 16


def test_matrix_rows_are_bounded_and_met_one_shard_at_a_time(spark, monkeypatch):
    from clickfolk.llm import filter_audit as A

    monkeypatch.setattr(A, "BLOCK_CELLS", 50)
    rows = [(k, " ".join(f"w{(k * 7 + i) % 90}" for i in range(k % 40))) for k in range(200)] + [(200, None), (201, ""), (None, "w1 w1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2)
    matrix, dictionary = A.document_term_matrix(docs, F.col("doc_id"), F.col("text"), shard_bytes=3000, bucket_entries=20)
    blocks = matrix.collect()
    assert len(blocks) > len({b["shard"] for b in blocks}) > 1 and max(len(b["words"]) for b in blocks) < 50 + 40
    words = {r["word_id"]: bytes(r["word"]).decode() for r in dictionary.collect()}
    found = [(doc, sorted((words[w], n) for w, n in zip(b["words"][a:e], b["counts"][a:e])))
             for b in blocks for doc, a, e in zip(b["rows"], b["begins"], b["begins"][1:])]
    assert sorted(found, key=repr) == sorted(((d, sorted(Counter((t or "").split()).items())) for d, t in rows), key=repr)
    # a task holds one group, not all of its partition's rows in one batch
    plan = matrix._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "MapInArrow _renumbered" not in plan


def test_matrix_of_texts_without_words(spark):
    docs = spark.createDataFrame([(1, " "), (2, None)], "doc_id bigint, text string")
    matrix, dictionary = document_term_matrix(docs, F.col("doc_id"), F.col("text"))
    assert values(row_sums(matrix)) == [(1, 0, 0), (2, 0, 0)] and dictionary.count() == 0


def test_words_and_hashes_of_a_byte_buffer():
    import numpy as np
    import pyarrow as pa

    from clickfolk.llm import filter_audit as A

    rng = random.Random(1)
    alphabet = ["a", "b", " ", "\t", "\n", "é", "x" * 7, "y" * 8, "z" * 33, "w" * 70, "\x0b", " "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))).encode() for _ in range(300)] + [b"", b"end", b"on"]
    column = pa.array([b"skipped", *texts], pa.binary()).slice(1)
    data, bounds = A._bytes_of(column)
    starts, lengths = A._words(data, bounds)
    words = [data[a:a + n].tobytes() for a, n in zip(starts, lengths)]
    assert A._joined(data, starts, lengths) == b"".join(w + b" " for w in words)
    assert words == [w for t in texts for w in t.split()]
    first, second = A._hashes(data, starts, lengths)
    assert len(set(first.tolist())) == len(set(second.tolist())) == len(set(words)) == len(set(zip(first.tolist(), words)))
    for a, b in ((first, second), (first % 7, second), (first % 7, second % 3), (first[:1], second[:1]), (first[:0], second[:0])):
        example, place = A._distinct(a, b)
        assert (a[example][place] == a).all() and (b[example][place] == b).all() and (np.diff(a[example].astype(float)) >= 0).all()
        assert len(example) == len(set(zip(a.tolist(), b.tolist())))
    assert A._words(np.empty(0, np.uint8), np.zeros(3, np.int64))[0].tolist() == []
