"""License scan: phrases and templates on texts with known answers."""

from riskloom.llm.licenses import TEMPLATES, Template, scan


def _scan(spark, texts, **k):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, Labels string")
    return {r.doc_id: r.licenses for r in scan(df, **k).collect()}


def test_known_texts(spark):
    got = _scan(spark, [
        None, "", "no notice here", "Released under the MIT License.", "x\nLicensed under CC BY-NC 4.0.\ny",
        "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License. The MIT license",
        "licensed under the gnu general public license version 3", "All rights reserved.", "licensed under the foo license",
        "apache license\nversion 2", "w " * 100_000 + "cc by nc cc by nc", "thé mit license", "THE MIT LICENSEE"])
    labels = [got[i].labels for i in range(len(got))]
    assert labels == ["", "", "", "mit", "cc-by-nc", "apache-2,mit", "gpl-3", "all-rights-reserved", "", "apache-2",
                      "cc-by-nc", "", ""]
    assert [got[i].base_labels for i in (3, 4, 5, 6, 9, 10)] == ["mit", "cc-by-nc", "apache-2,mit", "", "apache-2", "cc-by-nc"]
    assert (got[10].n_base, got[10].first_word, got[10].last_word, got[10].n_words) == (2, 100_000, 100_003, 100_006)
    assert (got[9].n_base, got[9].first_word) == (1, 0)
    assert got[0].n_words == 0 and got[0].first_word is None and got[0].score == 0 and got[3].score == 1
    assert got[5].n_base == 3 and got[8].score == 0


def test_threshold_is_exact(spark):
    words = [f"w{k}" for k in range(10)]
    t = (Template("ten", "w0", " ".join(words)),)
    texts = [" ".join(words[:n]) for n in range(11)] + [" ".join(words[10 - n:]) for n in range(11)] + \
        [" ".join(words[:4]) + "\n" + " ".join(words[4:])] + ["w0 " * 50, "w9 " * 9 + " ".join(words[:8])]
    got = _scan(spark, texts, templates=t, phrases={"zz top": "zz"})
    for i, text in enumerate(texts):
        best = max(len(set(line.split()) & set(words)) * ("w0" in line.split()) for line in text.split("\n"))
        assert (got[i].labels == "ten") == (best >= 8), text


def test_notice_over_lines_and_empty_table(spark):
    notice = ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in "
              "compliance with the License.\nYou may obtain a copy of the License at\nUnless required by applicable law or "
              "agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT "
              "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.")
    got = _scan(spark, [notice, notice])
    assert got[0].labels == got[1].labels == "apache-2" and got[0].n_blocks == 2
    assert scan(spark.createDataFrame([], "doc_id int, text string")).count() == 0


def test_every_notice_of_a_block_counts(spark):
    mit, apache, bsd = (next(t.text for t in TEMPLATES if t.label == x and len(t.words()) > 20) for x in ("mit", "apache-2", "bsd"))
    got = _scan(spark, [f"{mit}\n\n{bsd}", f"{apache}\n{mit}\n{bsd}",
                        "Licensed under the Apache License, Version 2.0. All rights reserved.",
                        "licensed under cc by nc 4.0", "licensed under cc by 4.0", "licensed under cc by nc sa 4.0",
                        "licensed under the gnu affero general public license version 3"])
    assert [got[i].labels for i in range(len(got))] == [
        "bsd,mit", "apache-2,bsd,mit", "all-rights-reserved,apache-2", "cc-by-nc", "cc-by", "cc-by-nc,cc-by-sa", "agpl-3"]
    assert got[2].n_blocks == 1
