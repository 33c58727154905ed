"""Operators on documents against plain loops."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clickfolk.llm import pieces as pieces_module
from clickfolk.llm import pii, simhash, toxicity
from clickfolk.llm.packing import _Encoder, pack, plan_packing, token_pieces
from clickfolk.llm.queries import TOKENIZERS
from clickfolk.llm.repetition import repetition_rules
from clickfolk.llm.rows import row_number_of
from clickfolk.llm.substring_dedup import remove_repeats
from llm_cases import no_docs, odd_docs  # noqa: F401  fixtures

BPE = f"{TOKENIZERS}/byte_bpe_50k.json"
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"


def plain_removed(rows, window):
    """(doc_id, text) rows -> per row the words that go, by the contract's own words."""
    first, windows = {}, []
    for doc, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            key, place = tuple(words[i : i + window]), (-1e18 if doc is None else doc, i)
            first[key] = min(first.get(key, place), place)
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < (-1e18 if doc is None else doc, i):
                gone[i : i + window] = [True] * window
        windows.append((doc, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return sorted(windows, key=repr)


@pytest.mark.parametrize("window,start", [(4, 2), (8, 2), (20, 10), (20, 20)])
def test_substring_dedup_equals_loop(spark, window, start):
    random.seed(window)
    rows = [(i, " ".join(random.choice("abc") + random.choice("\n \t") + random.choice("xy") for _ in range(random.randint(0, 60))))
            for i in range(60)]
    rows += [(100 + i, "a a a a a a a a a a a a a a a a a a a a a a a a a") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = remove_repeats(df, window=window, start=start).collect()
    assert sorted([tuple(r) for r in got], key=repr) == plain_removed(rows, window)


def test_substring_dedup_rows_of_one_id(spark):
    """A third of the rows have no id and another third share one; both are dealt out, results as in the loop."""
    random.seed(3)
    texts = [" ".join(random.choice("ab") for _ in range(random.randint(0, 30))) for _ in range(90)]
    rows = [((None, 7, 100 + i)[i % 3], text) for i, text in enumerate(texts)] + [(7, texts[1]), (7, texts[1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "map('k', 1) AS extra")
    got = remove_repeats(df, window=8, start=2)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == plain_removed(rows, 8)
    homes = df.select(F.pmod(row_number_of(df, "doc_id"), F.lit(11)).alias("home"), "doc_id").distinct()
    assert {r["n"] for r in homes.where("doc_id = 7 OR doc_id IS NULL").groupBy("doc_id").agg(F.count("*").alias("n")).collect()} <= {9, 10, 11}
    assert row_number_of(df.where("doc_id > 99"), "doc_id") is None


def test_substring_dedup_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = remove_repeats(odd_docs, window=20, start=5).collect()
    assert sorted([tuple(r) for r in got], key=repr) == plain_removed(rows, 20)
    assert remove_repeats(no_docs).count() == 0
    kept = remove_repeats(odd_docs, window=20, start=10, joined=False, carry=True)
    whole = {r.doc_id: r for r in kept.collect()}
    assert whole[5].kept == " \n\t " and whole[3].kept is None and whole[1].carried.home == 1
    assert whole[2].kept == "second two"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, bits):
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("limit", [4096, 14])
@pytest.mark.parametrize("bits", [2, 3])
def test_simhash_links_equal_loop(spark, limit, bits):
    """Dense clusters, chains and far values; a low limit sends most groups through the finer keys."""
    random.seed(bits)
    prints = set()
    for _ in range(6):
        centre = random.getrandbits(64)
        for _ in range(25):
            value = centre
            for _ in range(random.randint(0, 4)):
                value ^= 1 << random.randrange(64)
            prints.add(value)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fp bigint"), bits, limit)
    from clickfolk.llm.components import components

    got = {r.node: r.root for r in components(links).collect()}
    mine = [got.get(s, s) for s in signed]
    groups = plain_groups(prints, bits)
    same = collections.defaultdict(set)
    for a, b in zip(mine, groups):
        same[a].add(b)
    assert all(len(v) == 1 for v in same.values()) and len(same) == len(set(groups))


def test_simhash_odd_rows(odd_docs, no_docs):
    got = collections.defaultdict(list)
    for r in simhash.near_duplicates(odd_docs).collect():
        got[r.doc_id].append((r.fp & (2**64 - 1), r.component_id))
    for r in odd_docs.collect():
        assert plain_fingerprint(r.text) in [f for f, _ in got[r.doc_id]]
    assert got[3] == got[4] == got[5] == [(0, 3)] and got[7] == [got[7][0]] * 2
    assert simhash.near_duplicates(no_docs).count() == 0


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def luhn(s):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0

    digits = lambda v: re.sub("[^0-9]", "", v)
    fine = {"email": lambda v: True, "ip": lambda v: all(int(p) <= 255 for p in v.split(".")),
            "card": lambda v: 14 <= len(digits(v)) <= 19 and luhn(digits(v)), "phone": lambda v: 10 <= len(digits(v)) <= 15}
    return sorted((m.start(), k, m.end()) for k, name in enumerate(BASE) for m in re.finditer(BASE[name], text) if fine[name](m[0]))


def test_pii_equals_loop(spark):
    random.seed(3)
    parts = ["a@b.c", "x.y_z@e-f.gh", "1.2.3.4", "300.1.1.1", "0001.2.3.255", "4041894974608795", "4041 8949-7460 8795", "+1 (988) 555-2485",
             "+12", "@", ".", "é", "日本", " ", "_d@e.f", "1.2.3.4.5.6.7.8", "+1+2 345 678 9012 3", "\n", "a@b", "123-45-6789", "++", "..@.."]
    rows = [(i, "".join(random.choice(parts) for _ in range(random.randint(0, 14)))) for i in range(400)]
    rows += [(1000, "7" * 20000), (1001, "a" * 20000 + "@"), (1002, "1." * 9000), (1003, "+1" + " " * 9000), (1004, "a@" + "b." * 9000 + "c")]
    got = pii.find_spans(spark.createDataFrame(rows, "doc_id bigint, text string"), more=[])
    for r in got.collect():
        assert [(s.start, s.order, s.end) for s in r.spans] == plain_spans(r.text), r.text[:200]


def test_pii_context_checksums_and_masks(spark, odd_docs, no_docs):
    texts = ["pay to account DE89370400440532013000 now", "DE89370400440532013001", "ssn 123-45-6789", "part 123-45-6789", None, "",
             "mail a@b.cd 4041894974608795", "GB82 WEST 1234 5698 7654 32"]
    df = pii.find_spans(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string"))
    rows = {r.doc_id: r for r in df.withColumn("m", pii.masked(F.col("text"), F.col("spans"))).collect()}
    assert [[s.kind for s in rows[i].spans] for i in range(8)] == [["iban"], [], ["ssn"], [], [], [], ["email", "card"], ["iban"]]
    assert rows[0].m == "pay to account [IBAN] now" and rows[4].m is None and rows[6].m == "mail [EMAIL] [CARD]"
    assert pii.find_spans(odd_docs).count() == 13 and pii.find_spans(no_docs).count() == 0


def plain_rules(text):
    raw = (text or "").encode()
    words = raw.split()
    places = collections.defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    covered = {i + k for v in places.values() if len(v) > 1 for i in v for k in range(5)}
    lines, seen, repeated = (text or "").split("\n"), set(), 0
    for line in lines:
        if line.encode().split():
            repeated += line in seen
            seen.add(line)
    longest = 0
    for i in range(len(words)):
        for j in range(i):
            k = 0
            while i + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            longest = max(longest, k)
    return (len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), repeated, len(covered), longest)


def test_repetition_equals_loop(spark, no_docs):
    random.seed(4)
    rows = [(i, " ".join(random.choice(["a", "b", "c#", "é|", "\n", "x\ny"]) for _ in range(random.randint(0, 70)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "a\n" * 30), (903, "  a b \x1c c")]
    got = {r.doc_id: r for r in repetition_rules(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for doc, text in rows:
        r, plain = got[doc], plain_rules(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.longest_repeat) == plain, text
        assert r.base_failed == (plain[0] < 10 or 100 * plain[4] > 20 * plain[0]) and not (r.base_failed and r.kept)
    assert repetition_rules(no_docs).count() == 0


def test_repetition_odd_rows(odd_docs):
    rows = repetition_rules(odd_docs).collect()
    assert len(rows) == 13 and {r.doc_id for r in rows if r.kept} >= {1, 2}
    assert [r.kept for r in rows if r.doc_id == 6] == [False]


def test_encoder_equals_library():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(BPE)
    random.seed(5)
    parts = ["the", " ", "  ", "\n", "\t", "é", "don't", "'ll", "12", "#!", "日本", " ", "　", "<|endoftext|>", "x" * 70, "\r\n", "\x85"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 25))) for _ in range(500)]
    ours = _Encoder(BPE).encode(texts)
    assert ours == [np.array(model.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_packing_whole_and_tight(spark, odd_docs, no_docs):
    pieces = token_pieces(odd_docs, BPE, ids=True)
    packed = pack(pieces).collect()
    assert len(packed) == pieces.count() and {r.length for r in packed if r.doc_id in (3, 4)} == {1}
    by = collections.defaultdict(list)
    for r in packed:
        by[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) == -(-sum(r.length for r in packed) // 2048)
    assert pack(token_pieces(no_docs, BPE)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_each_piece_once(seed):
    random.seed(seed)
    capacity = 300
    counts = np.array([0] + [random.choice([0, 1, 3, 50]) if random.random() < 0.5 else 0 for _ in range(capacity)])
    seen, fill = np.zeros_like(counts), collections.Counter()
    for length, first, n, begin, per in sorted(plan_packing(counts, capacity)):
        assert first == seen[length]
        seen[length] += n
        for k in range(n):
            fill[begin + k // per] += length
    assert (seen == counts).all() and max(fill.values(), default=0) <= capacity
    rooms: list[int] = []  # as many as best fit over all pieces, longest first, or nearly so
    for length in range(capacity, 0, -1):
        for _ in range(int(counts[length])):
            best = min((r for r in rooms if r >= length), default=capacity)
            if best in rooms:
                rooms.remove(best)
            rooms.append(best - length)
    assert len(fill) <= 1.05 * len(rooms) + 1


def every_way(vocabulary, chunk):
    marked = chunk.replace(pieces_module.MARK, "\0").replace(" ", pieces_module.MARK)

    def ways(i):
        if i == len(chunk):
            yield 0.0
            return
        single = False
        for j in range(i + 1, len(chunk) + 1):
            entry = vocabulary.pieces.get(marked[i:j])
            if entry:
                single = single or j == i + 1
                yield from (entry[1] + w for w in ways(j))
        if not single:
            yield from (vocabulary.spelled(chunk[i])[1] + w for w in ways(i + 1))

    return sorted(ways(0), reverse=True)


@pytest.mark.parametrize("text", ["", "the cat", "a  b\n c", "▁x ▁", "日本 ü\x00", "ing of", "\n\n"])
def test_nbest_equals_every_way(text):
    vocabulary = pieces_module._vocabulary(PIECES)
    for n in (1, 2, 4):
        found = pieces_module.best_of_text(text, pieces_module._Searched(vocabulary, n))
        assert np.allclose([s for s, _ in found], every_way(vocabulary, " " + text)[:n])
        assert len({b for _, b in found}) == len(found)
        assert all(vocabulary.decode(np.frombuffer(b, "<u4").tolist()) == text for _, b in found)


def test_pieces_round_trip_odd_rows(odd_docs, no_docs):
    encoded = pieces_module.encode_nbest(odd_docs, PIECES, 2)
    best = encoded.where("rank = 1")
    texts = sorted(r.text for r in pieces_module.decode(best, PIECES).collect())
    assert texts == sorted(r.text or "" for r in odd_docs.collect())
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=PIECES)
    for r in best.where("doc_id in (1, 10)").collect():
        assert model.decode(np.frombuffer(r.ids, "<u4").tolist()) in {d.text for d in odd_docs.collect()}
    crc = {r.doc_id: r for r in pieces_module.digests(encoded, PIECES).where("rank = 1 and doc_id = 1").collect()}
    assert crc[1].decoded_sha256 == hashlib.sha256(odd_docs.where("doc_id = 1").first().text.encode()).hexdigest()
    assert pieces_module.encode_nbest(no_docs, PIECES).count() == 0


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(toxicity.graded(toxicity.sample_of(labels.where("doc_id % 2 = 0"), docs)))
    held = toxicity.score(docs, model).join(labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "label"), "doc_id").collect()
    right = sum(r.toxic == bool(r.label) for r in held) / len(held)
    clean = [r for r in held if not r.label]
    assert right > 0.93 and sum(r.toxic for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r.expected_severity <= 2 and r.severity_grade in (0, 1, 2) for r in held)


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 0), (2, 0), (None, 1)], "doc_id bigint, toxic int")
    one_side = toxicity.fit(toxicity.graded(toxicity.sample_of(labels, odd_docs)))
    scored = toxicity.score(odd_docs, one_side).collect()
    assert len(scored) == 13 and not any(r.toxic for r in scored)
    assert toxicity.without_toxic(odd_docs, one_side).columns == odd_docs.columns
    assert toxicity.score(no_docs, one_side).count() == 0


def test_thresholds_are_ordered_and_shared():
    grades = np.array([0, 0, 0, 1, 1, 2, 2] * 20)
    rows = [{0: float(g), 1: 1.0} for g in grades]
    weights, limits = toxicity._fitted(grades, rows, 2, 2, 1e-4, 300)
    assert weights[0] > 0 and list(limits) == sorted(limits)
    model = toxicity.Model({}, weights, limits)
    above = model.above([{0: 0.0, 1: 1.0}, {0: 1.0, 1: 1.0}, {0: 2.0, 1: 1.0}])
    assert (np.diff(above.sum(axis=1)) > 0).all() and (above[:, 0] >= above[:, 1]).all()
