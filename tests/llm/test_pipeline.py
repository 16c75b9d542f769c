import random
import re

import corpus_pipeline
from tests.llm import brute
from tickflow.llm import pii, quality_rules, toxicity


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def test_stages_against_a_plain_version(spark, tmp_root):
    random.seed(9)
    vocabulary = [f"word{i}" for i in range(500)]

    def prose(n):
        return "\n".join(" ".join(random.choice(vocabulary) for _ in range(9)) + "." for _ in range(n))

    rows = [prose(random.randint(7, 20)) for _ in range(60)]
    rows += [rows[0], rows[0], rows[1].replace("word1 ", "word2 ", 1), rows[2] + " tail."]      # copies and near copies
    rows += [rows[3] + "\nNAVIGATION LINE IN CAPITALS!!", "Home | A | B | C\n" * 30, "short", None, ""]
    rows += [prose(8) + f"\nWrite to jo.{i}@mail.example.com or call (988) 555-24{i:02d} soon." for i in range(10, 13)]
    toxic = [prose(8).replace("word7", "badword") + " badword vileword badwordly." for _ in range(12)]
    docs = [(i, t, "en", "src", len(t or "")) for i, t in enumerate(rows + toxic)]
    docs.append((None, prose(8), "en", "src", 1))
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_root}/documents.parquet")
    labels = [(i, 1, 0) for i in range(50)] + [(len(rows) + i, 1, 1) for i in range(9)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_root}/labels.parquet")

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality_rules", "ngram_jaccard_join", "pii", "best_fit_packing"]
    now = spark.read.parquet(f"{tmp_root}/documents.parquet")
    states = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, tmp_root)
        if k < 4:
            assert out.schema.names == frame.schema.names
        path = f"{tmp_root}/stage-{k}"
        out.write.parquet(path)
        now = spark.read.parquet(path)
        states.append([tuple(r) for r in now.collect()])
    after_toxic, after_rules, after_copies, after_pii, packed = states
    assert {r[0] for r in docs} - {r[0] for r in after_toxic} == {len(rows) + i for i in range(12)}
    verdict = {r.doc_id: r for r in quality_rules.line_first(frame).collect()}
    assert {r[0]: r[1] for r in after_rules} == {r[0]: verdict[r[0]].clean_text for r in after_toxic if verdict[r[0]].kept}
    found = brute.jaccard_components([(r[0], r[1]) for r in after_rules], 5, 80)
    assert {r[0] for r in after_copies} == {d for d, _, c in found if d is None or d == c}
    masks = {r.doc_id: r.text for r in pii.pseudonymise(frame, pii.EXAMPLE_KEY).collect()}
    for r in after_pii:
        assert "jo.1" not in r[1] and "555-24" not in r[1] and r[4] == len(r[1])
        assert r[1] == masks[r[0]] or "NAVIGATION" in (masks[r[0]] or "")
    total = {}
    for p in packed:
        total[p[0]] = total.get(p[0], 0) + p[3]
    assert total == {r[0]: len(words(r[1])) + 1 for r in after_pii}
    whole = corpus_pipeline.run(spark, tmp_root)
    assert sorted(map(str, ((r.doc_id, r.piece, r.length) for r in whole.collect()))) \
        == sorted(map(str, ((p[0], p[1], p[3]) for p in packed)))
