import numpy as np
import zlib

from cohortlens.llm import toxicity


def brute_kernel(a, b):
    def features(w):
        out = {}
        codes = [31] + [toxicity._codes[ord(c)] for c in w]
        n = len(codes)
        for i in range(n):
            for j in range(i + 1, n):
                for k in range(j + 1, min(n, i + toxicity.SPAN)):
                    if codes[i] and codes[j] and codes[k]:
                        u = (codes[i], codes[j], codes[k])
                        out[u] = out.get(u, 0) + toxicity.DECAY ** (k - i + 1)
        norm = np.sqrt(sum(v * v for v in out.values()))
        return {u: v / norm for u, v in out.items()}

    x, y = features(a), features(b)
    return sum(v * y.get(u, 0) for u, v in x.items())


def test_kernel_equals_all_subsequences():
    words = ["idiot", "i-d-i-o-t", "idxiot", "stupid", "aaaaaa", "été-là", "worthless!", "ab"]
    got = toxicity.kernel(words, toxicity._dense(words).astype(float))
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert abs(got[i, j] - brute_kernel(a, b)) < 1e-6
    assert got[0, 1] > 0.3 and got[0, 3] < 0.2


def test_segments():
    found = toxicity.segments("You i d i o t! Fine. S.t.u.p.i.d " + "x" * 60)
    assert {"idiot!"} & {w + "!" for w in found} and "you" in found
    assert {"idiot"} <= toxicity.segments("(i d i o t)") & toxicity.segments('"i d i o t?"')
    assert toxicity.segment_counts("No no x") == {"no": 2, "x": 1}
    assert all(len(w) <= toxicity.WINDOW for w in found)
    assert toxicity.segments(None) == set() == toxicity.segments("  ")


def test_machine_equals_landmark_kernels():
    toxic, clean = ["idiot", "stupid", "moron"], ["the", "there", "houses", "garden", "window"]
    machine = toxicity._fitted(toxic + toxicity._disguised(toxic), clean)
    assert machine.values(toxic).min() > 0 > machine.values(clean).max()
    assert machine.values(["id.iot", "s-t-u-p-i-d", "morxon"]).min() > machine.values(["thing", "winter"]).max()
    assert min(machine.values(["idxiot", "iddiot", "i*diot", "stupxid", "mo.ron"])) > machine.values(["thing", "winter"]).max()
    assert machine.values(["", "1"]).tolist() == [toxicity.LOWEST] * 2


def test_calibration_never_falls():
    draw = np.random.default_rng(1)
    x = draw.normal(size=3000)
    y = (draw.random(3000) < 1 / (1 + np.exp(-3 * x))).astype(float)
    at, share = toxicity.calibration(x, y)
    assert (np.diff(at) > 0).all() and (np.diff(share) >= 0).all() and 0 <= share[0] and share[-1] <= 1
    assert abs(np.interp(0.0, at, share) - 0.5) < 0.12


def test_held_out_accuracy_of_the_query(spark, sf):
    from cohortlens.llm.queries import op3_toxicity

    path = sf.replace("0.001", "0.1")
    rows = op3_toxicity(spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    toxic, clean = ([r["score"] for r in held if r["toxic"] == t] for t in (1, 0))
    ahead = np.mean([(s > np.array(clean)).mean() + (s == np.array(clean)).mean() / 2 for s in toxic])
    assert ahead > 0.93
    found = [r for r in held if r["predicted"]]
    assert sum(r["toxic"] for r in found) > 0.85 * len(found) and len(found) > 0.6 * len(toxic)


def test_defined_cases(spark, docs):
    df = docs([(1, None), (2, ""), (3, "1 2 3"), (None, "idiot"), (4, "x" * 100000), (1, None)], extra=True)
    one_class = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 1, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    got = toxicity.scored(df, one_class).collect()
    assert len(got) == 6 and {r["score"] for r in got} == {0.0}
    two = [(i, "you are an idiot now" if i % 2 else "a garden by the river") for i in range(1, 200)] + [(500, None), (501, "")]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 200)], "doc_id bigint, quality int, toxic int")
    scores = {r["doc_id"]: r["score"] for r in toxicity.scored(docs(two + [(600, "what an i-d-i-o-t"), (601, "id.iot !")]), labels).collect()}
    assert scores[1] > 0.9 > 0.1 > scores[2] and scores[500] == scores[501] <= scores[2]
    assert scores[600] > 0.5
    assert toxicity.scored(docs([]), labels).collect() == []
