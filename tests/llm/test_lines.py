import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from policy_mart.llm import lines

from .frames import empty, messy, rows_of, words

DATA = "/root/testdata/sf0.01"


def tokens(line):
    return [t if not re.search("[0-9]", t) else lines.FIELD for t in line.split(" ") if t]


def by_hand(texts, depth=3, least=5, constant=0.75, copy_share=0.5):
    """The numbers of the lines that each distinct text loses."""
    where = defaultdict(list)  # leaf -> (text, line number, tokens, line)
    for text in set(texts) - {None}:
        for i, line in enumerate(text.split("\n")):
            if t := tokens(line):
                where[len(t), tuple(t[:depth])].append((text, i, t, line))
    template = {}
    holders = defaultdict(set)
    for leaf, found in where.items():
        if len({f[0] for f in found}) < least:
            continue
        seen = Counter((p, t) for _, _, ts, _ in found for p, t in enumerate(ts[depth:]))
        for text, i, ts, _ in found:
            fixed = [(p, t) for p, t in enumerate(ts[depth:]) if seen[p, t] >= least]
            if len(fixed) >= constant * max(len(ts) - depth, 0):
                template[text, i] = (leaf, tuple(fixed))
                holders[template[text, i]].add(text)
    out = {}
    for text in set(texts) - {None}:
        n = [len(tokens(line)) for line in text.split("\n")]
        gone = [i for i in range(len(n)) if (text, i) in template and len(holders[template[text, i]]) >= least]
        out[text] = [] if sum(n[i] for i in gone) > copy_share * sum(n) else gone
    return out


def check(docs):
    originals = [r["text"] for r in docs.select("text").collect()]
    expected = by_hand(originals)
    got = lines.drop_recurring_lines(docs.withColumn("before", F.col("text"))).collect()
    assert len(got) == len(originals)
    for r in got:
        if r["before"] is None:
            assert r["text"] is None and r["dropped"] == [] and r["n_lines"] == 0
            continue
        own = r["before"].split("\n")
        assert r["dropped"] == expected[r["before"]] and r["n_lines"] == len(own)
        assert r["text"] == "\n".join(x for i, x in enumerate(own) if i not in set(r["dropped"]))


def test_documents(spark):
    check(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text"))


def test_fields_generalise_and_clean_lines_stay(spark):
    rows = []
    for i in range(12):
        footer = f"Page {i} of the report for customer {'abcdefghijkl'[i] * 5} was printed on the first day"
        rows.append((i, words(i, 40) + "\n" + footer + "\n" + words(100 + i, 40)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs)
    assert all(r["dropped"] == [1] for r in lines.drop_recurring_lines(docs).collect())


def test_copies_are_left_whole(spark):
    text = words(1, 40) + "\n" + words(2, 40)
    rows = [(i, text) for i in range(20)] + [(50 + i, text + "\n" + words(10 + i, 5)) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs)
    got = lines.drop_recurring_lines(docs)
    assert got.filter(F.size("dropped") > 0).isEmpty() and got.filter("doc_id >= 50 and not is_copy").isEmpty()


def test_messy_rows_stay_native(spark):
    docs = messy(spark)
    got = lines.drop_recurring_lines(docs)
    assert got.count() == docs.count() and set(docs.columns) <= set(got.columns)
    assert rows_of(got, "doc_id", "text", "`a.b`", "line") == rows_of(docs, "doc_id", "text", "`a.b`", "line")
    assert lines.drop_recurring_lines(empty(spark)).isEmpty()
    assert "Python" not in got._jdf.queryExecution().toString()
