import random

from textloom.llm import lines


def lcs_ok(a, b, pairs):
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_patience_aligns_unique_lines():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.randint(0, 12) for _ in range(rng.randint(0, 20))]
        b = [rng.randint(0, 12) for _ in range(rng.randint(0, 20))]
        lcs_ok(a, b, lines.patience(a, b))
    assert lines.patience([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]
    assert lines.patience([1, 9, 2, 3], [1, 2, 8, 3]) == [(0, 0), (2, 1), (3, 3)]


def spelled(a, b):
    """Patience diff as it is told: pairs of places of equal lines."""
    if not a or not b:
        return []
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    m = 0
    while m < min(len(a), len(b)) - n and a[len(a) - 1 - m] == b[len(b) - 1 - m]:
        m += 1
    ends = [(i, i) for i in range(n)] + [(len(a) - m + i, len(b) - m + i) for i in range(m)]
    x, y = a[n : len(a) - m], b[n : len(b) - m]
    once = [(x.index(h), y.index(h)) for h in dict.fromkeys(x) if x.count(h) == 1 == y.count(h)]
    chains = []  # the longest rising chain to each; of equals that of the earliest patience piles
    piles = []
    for i, j in once:
        k = next((k for k, (top, _) in enumerate(piles) if top >= j), len(piles))
        chain = ((piles[k - 1][1]) if k else []) + [(i, j)]
        piles[k : k + 1] = [(j, chain)]
        chains.append(chain)
    best = piles[-1][1] if piles else []
    out, p, q = [], 0, 0
    for i, j in [*best, (len(x), len(y))] if best else []:
        out += [(p + s, q + t) for s, t in spelled(x[p:i], y[q:j])]
        if i < len(x):
            out.append((i, j))
        p, q = i + 1, j + 1
    return sorted(ends + [(n + s, n + t) for s, t in out])


def test_patience_against_its_description():
    rng = random.Random(3)
    for _ in range(3000):
        a, b = ([rng.randint(0, rng.choice([3, 9, 30])) for _ in range(rng.randint(0, 14))] for _ in range(2))
        assert lines.patience(a, b) == spelled(a, b)


def brute(docs, least):
    """Every earlier document that shares a long line is a partner."""
    split = {i: (t or "").split("\n") for i, t in docs}
    key = {i: [x.strip(" \t\r\f\v") for x in v] for i, v in split.items()}
    out = {}
    for i in key:
        gone = set()
        for j in key:
            if j < i and any(len(h) >= least and h in key[j] for h in key[i]):
                run = []
                for x, y in [*spelled(key[j], key[i]), (-2, -2)]:
                    if run and run[-1] != (x - 1, y - 1):
                        if any(len(key[i][q]) >= least for _, q in run):
                            gone |= {q for _, q in run}
                        run = []
                    run.append((x, y))
        out[i] = "\n".join(x for n, x in enumerate(split[i]) if n not in gone)
    return out


def all_of(spark, docs):
    return {r.row.doc_id: r.kept for r in lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}


def test_all_earlier_documents_are_partners(spark):
    p, q = "the long line that is named p", "the long line that is named q"
    docs = [(1, f"{p}\nx\n{q}"), (2, f"{q}\n{p}"), (3, f"{q}\n{p}"), (4, f"v\n{q}\n{p}\nw\nz"), (5, f"r\n{p}\nw\nz\ns")]
    got = all_of(spark, docs)
    assert got == brute(docs, lines.LEAST)
    assert got[3] == "" and got[5] == "r\ns"


def test_all_against_brute_force(spark):
    rng = random.Random(8)
    pool = ["a long line number %d of many" % i for i in range(25)] + ["short", "", "s2", "s3"]
    docs = [(0, None), (1, ""), (2, "x" * 3000)]
    for i in range(3, 120):
        docs.append((i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 14)))))
    docs += [(130, docs[20][1]), (131, docs[20][1]), (132, "y\n" + docs[21][1] + "\r\nz")]
    rng.shuffle(docs)
    assert all_of(spark, docs) == brute(docs, lines.LEAST)


def test_extra_columns_and_repeated_rows(spark):
    text = "the very same long line of text"
    rows = [(7, text, "lines", 5), (1, text, "a", 1), (1, text, "a", 1), (None, text, "b", 2), (8, None, "c", 3), (9, "y\n" + text + "\r\nz", "d", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_lines int")
    got = sorted((r.row.doc_id or 0, r.kept, r.row.kept, r.row.n_lines) for r in lines.dedup_lines(df).collect())
    assert got == [(0, text, "b", 2), (1, "", "a", 1), (1, "", "a", 1), (7, "", "lines", 5), (8, "", "c", 3), (9, "y\nz", "d", 4)]


def test_documents_of_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.row.doc_id: r.kept for r in lines.dedup_lines(docs).collect()}
    want = brute(rows, lines.LEAST)
    assert len(got) == len(rows) and [i for i, _ in rows if got[i] != want[i]] == []


def test_all_of_no_rows(spark):
    assert lines.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_aligns_with_all(spark, tmp_path):
    import hashlib

    p, q = "the long line that is named p", "the long line that is named q"
    docs = [(1, f"{p}\nx\n{q}"), (2, f"{q}\n{p}"), (3, f"{q}\n{p}")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.kept_sha256 for r in lines.query(spark, str(tmp_path)).collect()}
    assert got[3] == hashlib.sha256(b"").hexdigest()
