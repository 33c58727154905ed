"""Columns of any name pass through the stages, and each stage does what a plain loop does."""

import random
import re

import corpus_pipeline

NAMES = ["_n", "_kept", "_key", "_spans", "_masked", "_row", "_text", "key", "n", "row", "spans", "masked", "kept", "carried",
         "n_words", "n_removed", "copy", "home", "doc", "fp", "root", "least", "toxic"]


def docs(spark):
    random.seed(5)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(4))
    passage = " ".join(word() for _ in range(30))
    texts = [" ".join(word() for _ in range(40)) for _ in range(6)]
    texts[1] = texts[1] + " " + passage
    texts[4] = passage + "  " + texts[4]
    texts[2] += " write to ann@site.org or 10.1.2.3"
    rows = [(i, t, len(t)) for i, t in enumerate(texts)] + [(7, texts[0], len(texts[0])), (8, None, None), (9, "", 0)]
    schema = "doc_id bigint, text string, n_chars bigint, " + ", ".join(f"`{n}` string" for n in NAMES)
    full = [(*r, *[f"{n}-{r[0]}" for n in NAMES]) for r in rows]
    return spark.createDataFrame(full, schema).repartition(3), {r[0]: r[1] for r in rows}


def check(out, df, want):
    assert out.columns == df.columns and out.schema.simpleString() == df.schema.simpleString()
    got = {r["doc_id"]: r for r in out.collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    for i, r in got.items():
        assert all(r[n] == f"{n}-{i}" for n in NAMES)
        assert r["n_chars"] == (None if r["text"] is None else len(r["text"]))


def test_near_duplicates(spark):
    df, texts = docs(spark)
    # 7 is a copy of 0; null and empty texts have the same fingerprint
    check(corpus_pipeline.drop_near_duplicates(spark, df, ""), df, {i: t for i, t in texts.items() if i not in (7, 9)})


def without_repeats(texts):
    """Every word of every window of 20 words that starts earlier goes, with the white space after it."""
    seen, out = set(), {}
    for i in sorted(texts):
        text = texts[i]
        if text is None:
            out[i] = None
            continue
        words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        gone = set()
        for a in range(len(words) - 19):
            window = tuple(text[b:e] for b, e in words[a : a + 20])
            if window in seen:
                gone.update(range(a, a + 20))
            seen.add(window)
        ends = [b for b, _ in words[1:]] + [len(text)]
        head = text[: words[0][0]] if words else text
        out[i] = head + "".join(text[words[k][0] : ends[k]] for k in range(len(words)) if k not in gone)
    return out


def test_repeated_passages(spark):
    df, texts = docs(spark)
    want = without_repeats(texts)
    assert want[4] != texts[4] and want[7] == ""
    check(corpus_pipeline.drop_repeated_passages(spark, df, ""), df, want)


def test_personal_data(spark):
    df, texts = docs(spark)
    want = {**texts, 2: texts[2].replace("ann@site.org", "[EMAIL]").replace("10.1.2.3", "[IP]")}
    check(corpus_pipeline.mask_personal_data(spark, df, ""), df, want)
