import numpy as np
from pyspark.sql import functions as F

from cyclelake.llm.toxicity import ToxicityModel, _one_per_family, clean_documents, fit_toxicity, fold, toxicity_scores

WORDS = "tree house river stone cloud paper green walk sing bread light chair".split()


def sample(n=300, seed=3):
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        words = [w + str(k) * 0 for w in rng.choice(WORDS, rng.integers(5, 60)) for k in range(1)]
        words = [w + "abcdefgh"[rng.integers(8)] for w in words]
        toxic = i % 4 == 0
        if toxic:
            at = rng.integers(len(words))
            words[at:at] = [["dreck", "vileness", "grubelo", "grubami"][rng.integers(4)] for _ in range(2)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_fold():
    assert fold("Ѕtuр1d, IDI0T!") == " stupid  idiot  " and fold("é4$y") == " éasy "


def test_held_out_accuracy_and_substitutions(spark, documents):
    rows, known = sample()
    labels = spark.createDataFrame(known, "doc_id long, toxic int")
    docs = documents(rows)
    out = toxicity_scores(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(held) > 30 and np.mean([r.predicted == r.toxic for r in held]) >= 0.95
    model = fit_toxicity(docs, labels)
    assert any(entry.startswith(" grub") for entry, _ in model.entries)   # a beginning stands for its words
    clean, plain, folded = model.scores(["river stone cloud", "river dreck cloud vileness", "river drесk cloud v1l3ness"])
    assert clean < 0.5 < plain and abs(plain - folded) < 1e-9
    assert clean_documents(docs, labels).columns == docs.columns


def test_matches_against_brute_force():
    entries = ((" bad ", 3.0), (" ugl", 2.0))
    model = ToxicityModel(entries, (fold("bad luck"),), (1.0, 1.0, 1.0, -2.0))
    for text in ("", "bad", "bad luck", "BAD uglier ugly bad luck", "xbad badx bad", "bad bad"):
        folded, total = fold(text), 0.0
        harmless = folded.replace(" bad luck ", " ##### #### ")
        for entry, weight in entries:
            total += weight * sum(harmless.startswith(entry, i) for i in range(len(harmless)))
        assert model.measures(text)[0] == np.log1p(total)


def test_odd_rows(spark, documents):
    rows, known = sample(120, seed=4)
    rows += [(1000, None), (1001, ""), (None, "dreck"), (1002, "tree " * 50_000 + "dreck"), (1002, "tree"), (1002, "tree")]
    labels = spark.createDataFrame(known + [(None, 1), (5, None)], "doc_id long, toxic int")
    df = documents(rows).withColumn("score", F.lit("clash")).withColumn("_text", F.lit(1))
    out = toxicity_scores(df, labels).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity_scores(documents(rows[:5]), nothing).collect()} == {0.5}
    assert toxicity_scores(documents([]), labels).count() == 0


def test_only_near_copies_go(spark):
    rng = np.random.default_rng(6)
    common = [f"common{i}" for i in range(10)]
    rows = [(i, i % 2, " ".join(rng.permutation(common + [f"own{i}x{k}" for k in range(20)]))) for i in range(300)]
    copies = [(1000 + i, i % 2, f"{text} changed{i}") for i, _, text in rows[:20]] + [(2000 + i, 0, "") for i in range(3)]
    sample = spark.createDataFrame(rows + copies, "_id long, _toxic int, _text string")
    kept = sorted(r._id for r in _one_per_family(sample).collect())
    assert kept == [*range(300), 2000]
