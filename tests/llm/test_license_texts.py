"""License headers with further words, and license files that hold the full text."""

import random

from tarn.llm.licenses import full_texts, scan_licenses

ORDINARY = "you may not use this file except in compliance with the rights of all other people who see that it can be found here today".split()
HEADERS = {
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.': "Apache-2.0",
    "Copyright (c) 2020 Jane Doe. Released under the MIT License, see the file that can be found here.": "MIT",
}


def prose(n):
    """Lines of ordinary words."""
    pick = random.Random(n)
    return "\n".join(" ".join(pick.choices([*ORDINARY, "copyright", "c", "2020", f"n{k}"], k=14)) for k in range(n))


def scan(spark, files):
    df = spark.createDataFrame([(k, p, t) for k, (p, t) in enumerate(files)], "file long, path string, body string")
    return {r["path"]: (r["license"], r["origin"], r["directory"]) for r in scan_licenses(df, "file", "path", "body").collect()}


def test_headers_with_ordinary_words(spark):
    """Words that are common in the files weigh little beside the statement."""
    files = [(f"prose/{k}", prose(300 + k)) for k in range(20)]
    files += [(f"code/{k}", f"{line}\n{prose(40)}") for k, line in enumerate(HEADERS)]
    got = scan(spark, files)
    assert [got[f"code/{k}"][:2] for k in range(len(HEADERS))] == [(name, "header") for name in HEADERS.values()]
    assert all(got[f"prose/{k}"] == (None, None, None) for k in range(20))


def test_full_texts_speak_for_their_directories(spark):
    texts = dict(full_texts())
    mit = texts["MIT"].replace("<year> <copyright holders>", "2020 Jane Doe and contributors")
    files = [("a/LICENSE", mit), ("a/x/y.py", "words"), ("b/LICENSE", texts["Apache-2.0"].upper()), ("b/z.py", None), ("c/q.py", prose(50))]
    files += [(f"all/{name}/LICENSE", text) for name, text in texts.items()]
    got = scan(spark, files)
    assert got["a/LICENSE"] == ("MIT", "file", None) and got["a/x/y.py"] == ("MIT", "inherited", "a")
    assert got["b/LICENSE"] == ("Apache-2.0", "file", None) and got["b/z.py"] == ("Apache-2.0", "inherited", "b")
    assert got["c/q.py"] == (None, None, None)
    assert all(got[f"all/{name}/LICENSE"] == (name, "file", None) for name in texts)
