"""The licence scan and its SQL agree on texts made to differ: repeated tails, overlapping notices, edges."""

from collections import Counter

import duckdb
import numpy as np

from palimpsest.llm import license_scan


def test_scan_and_sql_agree(spark):
    rng = np.random.default_rng(5)
    bits = [t for t, _ in (*license_scan.BASE, *license_scan.NOTICES)]
    texts = ["released under the mit license the mit license", "Released under the MIT License.", "mit license " * 9, None, "", "mit", "license mit license"]
    for _ in range(150):
        words = " ".join(rng.choice(bits, rng.integers(1, 4))).split()
        for _ in range(rng.integers(0, 6)):
            k = int(rng.integers(0, len(words) + 1))
            words[k:k] = list(rng.choice(["mit", "license", "the", "x", "under", "released"], rng.integers(1, 4)))
            if rng.random() < 0.5 and len(words) > 3:
                del words[int(rng.integers(0, len(words)))]
        texts.append(" ".join(words))
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = license_scan.scan(docs).drop("spans")
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(license_scan._sql())
    names = [d[0] for d in want.description]
    norm = lambda r: tuple(round(v, 9) if isinstance(v, float) else v for v in r)
    assert Counter(norm(tuple(r[c] for c in names)) for r in got.collect()) == Counter(map(norm, want.fetchall()))
    assert "mit-notice" in got.where("doc_id is null").orderBy("n_words").collect()[-1].labels or any("notice" in r.labels for r in got.collect())
