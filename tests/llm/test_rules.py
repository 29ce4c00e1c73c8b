"""Rules per document and host against plain Python."""

import random
import re

from pyspark.sql import functions as F

from documents import frame  # noqa: F401

from cuadrante.llm.host_rules import host_rates, host_rules


def plain(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_figures(frame):
    rng = random.Random(3)
    texts = [None, "", "  \t\n", "one", " x y", "a b c d e f g h " * 2, "a b c d e f g h i " * 9, "same same same " * 40, "l1\nl1\n\nl2\n l1\nl2", "# * $ % & | < > é"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    texts.append(" ".join(rng.choice(["x", "y", "zz\n"]) for _ in range(5000)))
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None) for i, t in enumerate(texts)]
    out = {r["doc_id"]: r for r in host_rules(frame(rows)).collect()}
    assert len(out) == len(rows)
    for i, t in enumerate(texts):
        r, (n, c, s, d, k) = out[i], plain(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, c, s, d, k), t
        assert r["base_failed"] == (n < 20 or 100 * k > 30 * n)


def test_hosts(spark, frame):
    good = " ".join(f"w{i}" for i in range(30))
    rows = [(i, good, "en", "good") for i in range(400)] + [(1000 + i, "bad", "en", "bad") for i in range(300)] + [(2000, good, "en", "bad"), (3000, good, "en", None), (3001, "bad", "en", None), (4000, good, "en", "tiny")]
    out = {r["doc_id"]: r for r in host_rules(frame(rows)).collect()}
    assert out[0]["kept"] and not out[1000]["kept"] and not out[2000]["kept"] and not out[2000]["base_failed"]
    assert out[3000]["kept"] and not out[3001]["kept"] and out[3000]["host_rate"] is None and out[4000]["kept"]
    assert host_rules(frame([])).count() == 0


def test_rates_shrink(spark):
    flags = spark.createDataFrame([("a", i % 10 == 0) for i in range(1000)] + [("b", i % 2 == 0) for i in range(1000)] + [("c", True)], "h string, f boolean")
    got = {r["h"]: r["host_rate"] for r in host_rates(flags, "h", "f").collect()}
    assert abs(got["a"] - 0.1) < 0.01 and abs(got["b"] - 0.5) < 0.01 and 0.3 < got["c"] < 1
    alike = flags.filter("h <> 'c'").withColumn("f", F.lit(False))
    assert {r["host_rate"] for r in host_rates(alike, "h", "f").collect()} == {0.0}


def test_shared_lines(frame):
    from cuadrante.llm.line_dedup import line_dedup

    rows = [(i, f"own {i}\n  Share this page \n\nbody {i}\nmany copies", "en", f"site{i % 12}") for i in range(40)]
    rows += [(100 + i, "nine sites\nrest", "en", f"site{i % 9}") for i in range(30)] + [(200 + i, "ten sites\nten sites", "en", f"site{i}") for i in range(10)]
    rows += [(300, "Share this page", "en", None), (301, None, "en", "site1"), (302, "", "en", "site1"), (303, "\t\n \n", None, None), (None, "many copies\nx", "en", "site3"), (304, "alone\n" * 5, "en", "s"), (304, "alone\n" * 5, "en", "s")]
    sites = {}
    for _, t, _, s in rows:
        for line in (t or "").split("\n"):
            if line.strip(" \t\r\x0b\x0c") and s:
                sites.setdefault(line.strip(" \t\r\x0b\x0c"), set()).add(s)
    want = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if len(sites.get(x.strip(" \t\r\x0b\x0c"), ())) < 10]
        want.append((i, "\n".join(left), sum(bool(x.strip(" \t\r\x0b\x0c")) for x in lines), len(lines) - len(left)))
    n_shared = sum(len(s) >= 10 for s in sites.values())
    for sent_lines in (2_000_000, n_shared, n_shared - 1, 0):
        got = [(r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in line_dedup(frame(rows), sent_lines=sent_lines).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want)), sent_lines
    assert line_dedup(frame([])).count() == 0


def test_shared_lines_of_long_texts_stay_in_place(spark, frame):
    """Whole texts are looked through, and no text is shuffled."""
    from cuadrante.llm.line_dedup import line_dedup

    long = "\n".join(["menu", *(f"line {i} of a long text" for i in range(60_000)), "menu"])
    rows = [(i, f"menu\nown {i}", "en", f"site{i}") for i in range(15)] + [(99, long, "en", "site0"), (98, "x" * 2_000_000 + "\n menu", "en", None)]
    out = line_dedup(frame(rows))
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in out.collect()}
    assert got[99] == (long[5:-5], 2) and got[98] == ("x" * 2_000_000, 1) and got[3] == ("own 3", 1)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = line_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    joined = line_dedup(docs, sent_lines=0)._jdf.queryExecution().executedPlan().toString()
    assert "Join" in joined


def test_hashes_that_agree_by_half(spark):
    """Lines are compared by both halves of their hashes."""
    from cuadrante.llm.line_dedup import _sent

    shared = spark.createDataFrame([((1, 2),), ((1, 3),), ((5, 5),)], "h struct<a:long,b:long>")
    rows = spark.createDataFrame([([1, 1, 1, 5, 0], [2, 3, 4, 5, 0]), ([], []), ([9], [9])], "a array<long>, b array<long>").coalesce(1)
    got = [r[0] for r in rows.select(_sent(shared)("a", "b")).collect()]
    assert got == [[True, True, False, True, False], [], [False]]
