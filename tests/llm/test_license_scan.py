import re

import pytest

from feedlake.llm import license_scan as scan


def shingles(text):
    own = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(own[i : i + 3]) for i in range(len(own) - 2)] or ([tuple(own)] if own else [])


def brute(rows, templates):
    """Documents and licenses of which some window contains enough."""
    out = set()
    for doc_id, text, *_ in rows:
        own = shingles(text)
        for name, notice in templates:
            wanted = set(shingles(notice))
            if not wanted:
                continue
            length = scan.window_length(len(shingles(notice)))
            for start in range(0, len(own), max(1, length // 4)):
                if len(set(own[start : start + length]) & wanted) >= 0.8 * len(wanted):
                    out.add((doc_id, name))
    return out


@pytest.fixture(scope="module")
def case(documents, hostile_rows, prose):
    notices = list(scan.NOTICES.items())
    rows = list(hostile_rows)
    for i, (_, notice) in enumerate(notices * 3):
        before, after = " ".join(prose(i, 7 + 13 * i)), " ".join(prose(i + 99, 5 + i))
        shown = [notice, notice.upper().replace(" ", "  \n"), notice.replace(",", "").replace("License", "Licence")][i % 3]
        rows.append((100 + i, f"{before} {shown} {after}"))
    rows.append((900, "Released under the MIT License. " * 300))
    rows.append((901, "licensed under the terms of an agreement"))
    return rows, documents(rows), notices


@pytest.mark.parametrize("block_shingles", [scan.BLOCK_SHINGLES, 12])
def test_finds_what_windows_contain(spark, case, block_shingles):
    rows, docs, notices = case
    found = scan.found_notices(docs, scan.notices(spark), block_shingles=block_shingles).collect()
    assert {(r["doc_id"], r["license"]) for r in found} == brute(rows, notices)
    assert all(0.8 <= r["containment"] <= 1 for r in found)
    place = {(r["doc_id"], r["license"]): r["first_word"] for r in found}
    assert place[900, "MIT"] == 0


def test_repeated_rows_and_odd_templates(spark, documents):
    docs = documents([(1, "All rights reserved."), (1, "All rights reserved."), (None, "Copyright: all rights reserved!")])
    templates = spark.createDataFrame(
        [("A", "All rights reserved"), ("A", "every right reserved"), ("B", None), ("C", "..."), (None, "rights")],
        "license string, text string",
    )
    found = sorted(map(tuple, scan.found_notices(docs, templates).collect()), key=str)
    assert [r[:3] for r in found] == [(1, "A", 1.0), (1, "A", 1.0), (None, "A", 1.0)]
    assert scan.found_notices(docs.limit(0), templates).count() == 0
    assert scan.found_notices(docs, templates.limit(0)).count() == 0


def test_bands_keep_their_promise():
    for similarity in (0.3, 0.5, 0.8, 0.95):
        count, rows = scan.bands(similarity)
        assert count * rows <= scan.HASHES and (1 - similarity**rows) ** count <= scan.MISSED
    with pytest.raises(ValueError, match="cannot"):
        scan.bands(0.01)


@pytest.mark.parametrize("shingles", range(1, 40))
def test_some_window_holds_a_run_wholly(shingles):
    length = scan.window_length(shingles)
    stride = max(1, length // 4)
    for place in range(100):
        assert any(s <= place and place + shingles <= s + length for s in range(0, place + 1, stride))


def test_main_path_is_native(spark, case):
    plan = scan.found_notices(case[1], scan.notices(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


LICENSE_FILES = {
    "MIT": """MIT License

Copyright (c) 2024 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
    "GPL": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.""",
    "LGPL": """ * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,""",
}


def test_license_texts_and_headers(spark, documents, prose):
    """As they stand in files, also in the middle of other text; each names one license."""
    rows = [(i, text) for i, text in enumerate(LICENSE_FILES.values())]
    rows += [(100 + i, " ".join(prose(i, 300)) + "\n" + text + "\n" + " ".join(prose(i + 50, 200))) for i, text in enumerate(LICENSE_FILES.values())]
    found = scan.found_notices(documents(rows), scan.notices(spark)).collect()
    names = {}
    for row in found:
        names.setdefault(row["doc_id"], set()).add(row["license"])
    for i, name in enumerate(LICENSE_FILES):
        assert names[i] == names[100 + i] == {name}
