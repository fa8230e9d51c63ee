from pathlib import Path

import pytest
from pyspark.sql import functions as F

from snapflow.llm import licenses


def found(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").withColumns({"license": F.lit(1), "digest": F.lit(2)})
    return sorted(tuple(r) for r in licenses.find(docs, licenses.known(spark)).select("doc_id", "scope", "license", "units").collect())


def test_variants(spark):
    mit = licenses.KNOWN[3][1]
    texts = [
        "Copyright (c) 2020 Somebody\n(C) Other\n" + mit.upper().replace("\n", " \n\t") + "\n", "RELEASED, under -- the mit licence!!", "x\nreleased under the mit license\ny\nReleased under the MIT License.\n",
        "Released under the MIT License. And more.", None, "", "...\n---", "This work is licensed under a Creative Commons Attribution-Non-Commercial 4.0 International License",
    ]
    assert found(spark, texts) == [(0, "whole", "MIT", 1), (1, "line", "MIT", 1), (1, "whole", "MIT", 1), (2, "line", "MIT", 2), (7, "line", "CC-BY-NC-4.0", 1), (7, "whole", "CC-BY-NC-4.0", 1)]


def test_repeated_rows_and_large_tables(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "Licensed under CC BY 4.0")] * 2 + [(None, "Licensed under CC BY 4.0")], "doc_id int, text string")
    rows = {(r["doc_id"], r["scope"]): r["units"] for r in licenses.find(docs, licenses.known(spark)).collect()}
    assert rows == {(1, "whole"): 2, (1, "line"): 2, (None, "whole"): 1, (None, "line"): 1}
    monkeypatch.setattr(licenses, "BROADCAST_ROWS", 1)
    assert licenses.find(docs, licenses.known(spark)).count() == 4
    assert licenses.find(docs.limit(0), licenses.known(spark)).count() == 0


def test_texts_of_several_lines_inside_documents(spark):
    mit = licenses.KNOWN[3][1]
    header = "\n".join("# " + line for line in licenses.KNOWN[6][1].replace("; you may", ";\nyou may").split("\n"))
    texts = [
        "# Tool\n\nWhat it does.\n\n## License\n\n" + mit.replace("MIT License\n", "MIT License\n\nCopyright (c) 2020 Somebody\n").replace(", ", ",\n") + "\n\nMore.",
        "#!/bin/sh\n#\n# Copyright 2020 Somebody\n#\n" + header + "\n#\n\nexit 0\n",
        "Intro.\n\nThis project is licensed under\nthe terms of the MIT license.\n\nEnd.",
        "The last part alone.\n\n" + mit.rsplit("\n\n", 1)[1],
        "Words.\n\n" + mit + "\n\nWords.\n\n" + mit,
    ]
    assert found(spark, texts) == [(0, "paragraph", "MIT", 1), (1, "paragraph", "Apache-2.0", 1), (2, "paragraph", "MIT", 1), (4, "paragraph", "MIT", 2)]


def test_entire_texts(spark):
    folder = Path("/usr/share/common-licenses")
    files = {"Apache-2.0": "Apache-2.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-2.1": "LGPL-2.1", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    if not all((folder / f).exists() for f in files.values()):
        pytest.skip("licence texts are not installed here")
    texts = [(folder / f).read_text() for f in files.values()]
    rows = found(spark, texts + ["Notes on the third party code.\n\n" + t for t in texts])
    assert [r[:3] for r in rows if r[0] < len(files)] == [(i, "whole", n) for i, n in enumerate(files)]
    assert {(len(files) + i, "paragraph", n, 1) for i, n in enumerate(files)} <= set(rows)
