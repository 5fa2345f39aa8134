"""A shard's size in the index and in the memory of the task that reads it."""


def _made(n=2000, terms=150):
    import numpy as np

    from kinweave.llm import search

    rng = np.random.default_rng(5)
    docs = []
    for _ in range(n):
        names = np.unique(rng.zipf(1.3, terms) % 50_000).astype(np.uint64)
        docs.append((names, rng.integers(1, 4, len(names)), 2 * len(names)))
    return search, docs, search.build_shard(list(range(n)), docs)


def test_shard_bytes_a_posting():
    _, docs, made = _made()
    postings = sum(len(d[0]) for d in docs)
    assert len(made["doc"]) + len(made["tf"]) <= 3 * postings


def test_shard_memory_a_posting():
    import tracemalloc

    import numpy as np

    search, docs, made = _made()
    postings = sum(len(d[0]) for d in docs)
    search.Shard(*made.values(), 300.0)  # what is imported on first use doesn't count
    tracemalloc.start()
    shard = search.Shard(*made.values(), 300.0)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    table = shard.table.nbytes
    assert peak - table <= 32 * postings and held - table <= 26 * postings
    # and it still scores as the formula says
    term = np.searchsorted(shard.names, docs[3][0])
    ids, score = shard.search(term, np.ones(len(term)), 5, 0.0, 3)
    want = []
    for i, (names, tf, words) in enumerate(docs):
        same = np.isin(names, docs[3][0])
        want.append((-round(float((tf[same] * 2.2 / (tf[same] + 1.2 * (0.25 + 0.75 * words / 300.0))).sum()), 6), i))
    want = [x for x in sorted(want) if x[1] != 3][:5]
    best = search.best_of(ids, score, 5)
    assert best[0].tolist() == [i for _, i in want] and np.allclose(best[1], [-s for s, _ in want])


def test_narrow_and_wide():
    import numpy as np

    from kinweave.llm import search

    for most, size in ((255, 1), (256, 2), (65535, 2), (65536, 4)):
        x = np.array([0, most, 7])
        assert len(search._narrow(x)) == 3 * size and search._wide(search._narrow(x), 3).tolist() == x.tolist()
    assert len(search._wide(search._narrow(np.empty(0, int)), 0)) == 0


def test_queries_side_by_side():
    """Each gets what it gets by brute force, also where lists after the pivot are skipped or read later."""
    import numpy as np

    search, docs, made = _made(700, 60)
    df = np.unique(np.concatenate([d[0] for d in docs]), return_counts=True)
    idf = np.log1p((700 - df[1] + 0.5) / (df[1] + 0.5))
    shard = search.Shard(*made.values(), 100.0, 128)
    asked = [0, 5, 9, 333]
    terms = [np.searchsorted(shard.names, docs[i][0]) for i in asked]
    terms = [t[np.argsort(-idf[t], kind="stable")] for t in terms]
    first = np.concatenate([[0], np.cumsum([len(t) for t in terms])])
    want = []
    for i in asked:
        scores = []
        for j, (names, tf, words) in enumerate(docs):
            same = np.isin(names, docs[i][0])
            weight = idf[np.searchsorted(df[0], names[same])]
            scores.append((-round(float((weight * tf[same] * 2.2 / (tf[same] + 1.2 * (0.25 + 0.75 * words / 100.0))).sum()), 6), j))
        want.append(sorted(x for x in scores if x[1] != i)[:5])
    for least in (np.zeros(4), np.array([-w[4][0] for w in want]), np.array([-w[0][0] for w in want])):
        kept = least.copy()
        got = {q: search.best_of(ids, s, 5) for q, ids, s in shard.search_all(np.concatenate(terms), idf[np.concatenate(terms)], first, 5, least, asked)}
        assert (least == kept).all()
        for q, w in enumerate(want):
            w = [x for x in w if -x[0] >= kept[q]]
            assert got[q][0][: len(w)].tolist() == [j for _, j in w] and np.allclose(got[q][1][: len(w)], [-s for s, _ in w])


def test_equal_texts_are_indexed_once(spark):
    """A table of copies takes the work of its distinct texts, and still gives every row its k best others."""
    from kinweave.llm import search

    texts = [f"alpha beta{i % 7} gamma{i % 3} delta{i}" for i in range(20)]
    rows = [(i + 100 * c, t) for c in range(30) for i, t in enumerate(texts)] + [(None, texts[0]), (5000, None), (5001, None), (7, "zeta other"), (7, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    copies = search.copies_of(docs, 11)
    once = search._once(docs, copies).collect()
    # the texts of id 7, which comes again, stand row by row
    assert len(once) == 18 + 2 * 30 + 1 + 1 + 1 and sum(r["many"] for r in once) == len(rows)
    got = {}
    for r in search.search(docs, k=10, every=50).orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append(r["doc_id"])
    assert sorted(got) == sorted(100 * c for c in range(30))  # null texts give nothing
    for q, ids in got.items():
        assert ids == [100 * c for c in range(12) if 100 * c != q][:10]
