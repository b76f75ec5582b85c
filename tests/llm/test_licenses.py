import re
import textwrap
from importlib.resources import files

from cooccur.llm import licenses

MIT = " ".join(licenses.TEMPLATES["MIT"].split())


def test_blocks_and_wording(spark, odd_rows):
    rows = [r[:2] for r in odd_rows] + [
        (400, "Some prose here.\nReleased under the MIT License.\nMore prose."), (401, "Licensed under the Apache License, Version 2.0."),
        (402, "x\n" + MIT.replace("without restriction", "with no restriction") + "\nend"), (403, "My driver's licence was renewed with the permission of my mother."),
        (404, "This work is licensed under the GNU General Public License, version 3."), (405, "Licensed under CC BY-NC 4.0."),
        (406, "one.\nReleased under the MIT License.\n" + "a\n" * 9 + "Licensed under CC BY-NC 4.0.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = licenses.scan_licenses(docs).collect()
    by = {}
    for r in sorted(found, key=lambda r: (r["doc_id"], r["start"])):
        by.setdefault(r["doc_id"], []).append(r)
        text = dict(rows)[r["doc_id"]]
        assert text[r["start"]:r["end"]] == r["block"] and r["known_bytes"] < r["plain_bytes"]
    names = {i: [r["license"] for r in own] for i, own in by.items()}
    assert names == {400: ["MIT"], 401: ["Apache-2.0"], 402: ["MIT"], 404: ["GPL-3.0"], 405: ["CC-BY-NC-4.0"], 406: ["MIT", "CC-BY-NC-4.0"]}
    assert sorted(by[402][0]["differences"]) == ["+no", "+with", "-without"] and by[400][0]["differences"] == []


def test_empty_and_clashing(empty, clashing):
    assert licenses.scan_licenses(empty).count() == 0
    assert licenses.scan_licenses(clashing, keep=("doc_id", "size")).count() == 0


NOTICE = """This program is free software{sign} you can redistribute it and/or modify it under the terms of the GNU {kind}General Public
License as published by the Free Software Foundation{sign} either version {version} of the License, or (at your option) any later version."""
MIT_WHOLE = "Copyright (c) 2019 Some Body\n\n" + "\n\n".join(re.split(r"(?<=so\.) |(?<=portions of the software\.) ", MIT.partition(" released under")[0]))


def test_whole_licenses_wrapped_and_not():
    known, alone = licenses._templates(licenses.TEMPLATES), licenses._compressor(None)
    names = lambda text: [f.license for _, _, f in licenses.confirmed(text, known, alone)]
    whole = {"MIT": MIT_WHOLE}
    for name in ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0"):
        whole[name] = files("cooccur.llm").joinpath("license_texts", f"{name}.txt").read_text("utf-8")
    for name in ("BSD-2-Clause", "BSD-3-Clause", "ISC"):
        whole[name] = " ".join(licenses.TEMPLATES[name].split()).partition(" released under")[0]
    for name, text in whole.items():
        paragraphs = [" ".join(p.split()) for p in re.split(r"\n\s*\n", text)]
        for form in (text, "\n".join(paragraphs), " ".join(paragraphs), "\n\n".join(textwrap.fill(p, 72) for p in paragraphs)):
            assert set(names(form)) == {name}, (name, form[:80])


def test_versions_and_names_are_told_apart():
    known, alone = licenses._templates(licenses.TEMPLATES), licenses._compressor(None)
    for name, kind, version, sign in (("GPL-2.0", "", "2", ";"), ("GPL-3.0", "", "3", ":"), ("LGPL-3.0", "Lesser ", "3", ":"), ("AGPL-3.0", "Affero ", "3", ":")):
        found = licenses.identify(NOTICE.format(kind=kind, version=version, sign=sign), known, alone)
        assert found and found.license == name
    assert licenses.identify("Licensed under the Apache License, Version 1.1.", known, alone) is None
    assert licenses.identify(NOTICE.format(kind="", version="7", sign=":"), known, alone) is None


def _whole():
    texts = {n: files("cooccur.llm").joinpath("license_texts", f"{n}.txt").read_text("utf-8") for n in ("Apache-2.0", "GPL-2.0", "GPL-3.0")}
    for n in ("MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC"):
        texts[n] = " ".join(licenses.TEMPLATES[n].split()).partition(" released under")[0]
    return texts


HEADINGS = {
    "MIT": ["MIT License", "The MIT License (MIT)", ""], "BSD-3-Clause": ["BSD 3-Clause License", "The BSD License", ""],
    "BSD-2-Clause": ["BSD 2-Clause License", ""], "ISC": ["ISC License", "The ISC License"]}


def _found(text):
    known, alone = licenses._templates(licenses.TEMPLATES), licenses._compressor(None)
    return [(f.license, end - start) for start, end, f in licenses.confirmed(text, known, alone)]


def test_headings_and_copyright_lines_belong_to_their_license():
    whole = _whole()
    for name, headings in HEADINGS.items():
        for heading in headings:
            body = whole[name]
            for form in (body, textwrap.fill(body, 76), "\n\n".join(re.split(r"(?<=[.:]) (?=[a-z]{4})", body))):
                file = f"{heading}\n\nCopyright (c) 2019 Some Body and others\n\n{form}\n" if heading else form
                found = _found(file)
                assert [n for n, _ in found] == [name], (name, heading, found)
                assert found[0][1] >= 0.9 * len(file.strip()), (name, heading, found, len(file))


def test_other_names_contradict():
    body = _whole()["MIT"]
    assert _found("Apache License\n\n" + body)[0][1] <= len(body) + 1
    assert not _found("Licensed under the Apache License, Version 1.1.")


def test_several_licenses_in_one_file():
    whole = _whole()
    for names in (("MIT", "BSD-2-Clause"), ("Apache-2.0", "MIT"), ("GPL-2.0", "GPL-3.0"), ("GPL-3.0", "GPL-3.0"), ("ISC", "MIT", "BSD-3-Clause")):
        file = "\n\n".join(whole[n] for n in names)
        found = _found(file)
        long = [n for n, size in found if size >= 300]
        assert long == list(names), (names, found)
        assert sum(size for _, size in found) >= 0.9 * len(file), (names, found)


def test_a_long_notice_file_takes_bounded_time():
    import time

    whole = _whole()
    entry = "\n\n".join(f"Component {i}\nCopyright (c) 20{i % 90 + 10} Author {i}\n\n{whole[n]}" for i, n in enumerate(("MIT", "BSD-3-Clause", "ISC", "MIT")))
    file = "\n\n".join(entry for _ in range(50))
    assert len(file) > 200_000
    began = time.time()
    found = _found(file)
    assert [n for n, size in found if size >= 300] == ["MIT", "BSD-3-Clause", "ISC", "MIT"] * 50
    assert time.time() - began < 120
