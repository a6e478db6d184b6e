"""Conversation repair, fill-in-middle and license scans against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from pressroom.llm import infill, license_scan, queries, repair

TEXTS = ["fine.", "what?", "cut off", "", " ", "yes!", "same.", "same.", "tail. \t", "\x0b\x0c", None]
ROLES = ["user", "assistant", "system", "tool", None, "", "use", "Assistant"]


def first_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """All lists of edits, by trying them out: rows are (role, text, fault); insertions as far as they can pay."""
    best = None

    def go(i, state, cost, letters, turns, inserted):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and (state == 0 or state == 3):
            best = min(best or (cost, letters, turns), (cost, letters, turns))
        if inserted < 2:
            role = "assistant" if state == 2 else "user"
            go(i, 3 if state == 2 else 2, cost + 3, letters + "I", [*turns, (role, "")], inserted + 1)
        if i == len(rows):
            return
        role, text, fault = rows[i]
        go(i + 1, state, cost + 4, letters + "D", turns, 0)
        if fault in ("blank", "duplicate"):
            return
        more = 3 if fault == "truncated" else 0
        new = "assistant" if state == 2 else "user"
        go(i + 1, 3 if state == 2 else 2, cost + 3 + more, letters + "R", [*turns, (new, text)], 0)
        initial = role[:1]
        if initial == "s" and state == 0:
            go(i + 1, 1, cost + more, letters + "K", [*turns, (role, text)], 0)
        if (initial == "u" and state != 2) or (initial == "a" and state == 2):
            go(i + 1, 2 if initial == "u" else 3, cost + more, letters + "K", [*turns, (role, text)], 0)

    go(0, 0, 0, "", [], 0)
    return best


def test_repair_finds_the_least_of_the_cheapest_edits():
    rng = random.Random(5)
    for _ in range(400):
        rows = [(rng.choice(ROLES[:4]), rng.choice(["x.", "y", "z!", ""]), f"{i}") for i in range(rng.randrange(1, 6))]
        faults = [rng.choice(["", "", "", "truncated", "duplicate", "blank"]) for _ in rows]
        job, found = repair.Repair(), []
        for row, fault in zip(rows, faults):
            found += job.add(row, row[0][:1], fault)
        cost, rest = job.finish()
        found += rest
        want = cheapest([(role, text, fault) for (role, text, _), fault in zip(rows, faults)])
        turns = [(row[0] if edit == "K" else role, row[1] if row else "") for edit, role, row in found if edit != "D"]
        assert (cost, "".join(e for e, _, _ in found), turns) == want, (rows, faults)


def test_repair_of_long_conversations_holds_few_rows():
    rng = random.Random(6)
    job, most, done = repair.Repair(), 0, 0
    for i in range(20_000):
        role = rng.choice(["user", "assistant", "system"]) if i % 7 == 0 else ("user", "assistant")[i % 2]
        done += len(list(job.add((i,), role[0], rng.choice(["", "", "truncated", "blank"]))))
        most = max(most, job.held())
    assert most < 200 and done > 19_000


def test_repair_of_a_long_tie():
    """Users only: whether the extra turn comes at the start or never is open to the end. All rows blank: nothing but deletions."""
    for fault, rows, letters, cost, held in (("", 3000, {"K", "R"}, 4500, 6000), ("", 3001, {"K", "R", "I"}, 4503, 6002), ("blank", 3000, {"D"}, 12000, 8)):
        job, most, found = repair.Repair(), 0, []
        for i in range(rows):
            found += job.add((i, "t"), "u", fault)
            most = max(most, job.held())
        paid, rest = job.finish()
        assert (paid, {e for e, _, _ in found + rest}) == (cost, letters) and most <= held
        if rows == 3001:
            assert "".join(e for e, _, _ in found + rest).startswith("KIKR")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out += [(conv, turn, "user" if hit == 4 else role, text)] * {0: 0, 3: 2}.get(hit, 1)
    return out


def expected_repair(rows):
    want = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        faults = first_faults([r[2:] for r in own])
        turns = {r[1] for r in own if r[1] is not None}
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, fixed = cheapest([(r[2], r[3], f) for r, f in zip(own, faults)])
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in fixed).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        want[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return want


@pytest.fixture
def folder(spark, tmp_path):
    """Writes a table where a registered query looks for it."""

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


def test_op11(spark, folder):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(ROLES), rng.choice(TEXTS)) for c in range(60) for t in range(rng.randrange(1, 7))]
    rows += [(None, 0, "user", "a."), (None, 1, "assistant", "b."), (70, None, "user", "q?"), (70, None, "user", "q?"), (70, 9, "assistant", "x" * 300_000 + ".")]
    rows += [(71, 5, "user", "b."), (71, 5, "user", "a."), (71, 5, "assistant", "a."), (72, None, None, None)]
    sf = folder("conversations", [(*r, "extra", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, fault string, seq int")
    found = queries.QUERIES["op11_conversation_repair"](spark, sf).collect()
    want = expected_repair(rows)
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in found}
    assert len(found) == len(want) and got == want


def test_op11_of_a_lost_conversation(spark, folder):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    sf = folder("conversations", [(gone, 0, "user", "a.")], "conv_id bigint, turn bigint, role string, text string")
    (lost,) = queries.QUERIES["op11_conversation_repair"](spark, sf).collect()
    assert tuple(lost) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_op11_of_nothing(spark, folder):
    sf = folder("conversations", [], "conv_id bigint, turn bigint, role string, text string")
    assert queries.QUERIES["op11_conversation_repair"](spark, sf).count() == 0


def members(kind):
    rng = np.random.default_rng(3)
    return {
        "few": np.array([0, 5, 65535]), "sparse": np.sort(rng.choice(65536, 3000, replace=False)), "dense": np.sort(rng.choice(65536, 30000, replace=False)),
        "all": np.arange(65536), "runs": np.concatenate([np.arange(100, 9000), np.arange(20000, 60000)]), "last": np.array([65535]),
    }[kind]


@pytest.mark.parametrize("kind, container", [
    ("few", infill.ArrayContainer), ("sparse", infill.ArrayContainer), ("dense", infill.BitmapContainer), ("all", infill.RunContainer),
    ("runs", infill.RunContainer), ("last", infill.ArrayContainer),
])
def test_containers_select(kind, container):
    own = members(kind)
    made = infill.container(own)
    assert isinstance(made, container) and made.bytes <= 8192
    ks = {0, len(own) - 1, *np.random.default_rng(1).integers(0, len(own), 300)}
    assert all(made.select(int(k)) == own[k] for k in ks)


def test_boundary_set_over_ranges():
    whole, made = [], infill.BoundarySet()
    for key, kind in ((0, "sparse"), (1, "dense"), (4, "all"), (7, "last")):
        made.add(key, members(kind))
        whole += (members(kind) + key * 65536).tolist()
    made.add(9, np.array([], int))
    assert len(made) == len(whole)
    assert all(made.select(k) == whole[k] for k in range(0, len(whole), 97)) and made.select(len(whole) - 1) == whole[-1]
    for k in (-1, len(whole)):
        with pytest.raises(IndexError):
            made.select(k)


TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@pytest.mark.parametrize("text", [
    "", " ", "a", " a", "a ", "a b", "  é 𝄞\t\n", "x" * 65536, "x" * 65535 + " ", "x" * 65535 + " y", "x" * 65536 + " y " * 40000, " " * 70000 + "z", " \x85 b\x0b",
])
def test_token_ends(text):
    ends = infill.token_ends(np.frombuffer(text.encode(), np.uint8))
    want = np.cumsum([len(t.encode()) for t in TOKEN.findall(text)]).tolist()
    assert [ends.select(k) + 1 for k in range(len(ends))] == want


def expected_infill(doc_id, text):
    text = text or ""
    units = TOKEN.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    form = "plain" if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50 else "spm" if h[3] % 100 < 80 else "psm"
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    chars = (None, None) if form == "plain" else (len(p), len(m))
    return (doc_id, n, form, *chars, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_op12(spark, folder):
    rng = random.Random(8)
    pool = ["a", "bé", " ", "\n", "𝄞", "<", "P>", "<S", ">", "word", "\t\t", "x" * 50, " "]
    rows = [(i, "".join(rng.choice(pool) for _ in range(rng.randrange(0, 30)))) for i in range(600)]
    rows += [(600, None), (601, ""), (602, "<M>"), (603, "y <P> z"), (None, "no id here"), (None, "no id here"), (5, "another text under 5"), (700, "w " * 200_000), (701, "<S<S a <")]
    sf = folder("documents", [(*r, "x", 3) for r in rows], "doc_id bigint, text string, form string, h1 int")
    found = queries.QUERIES["op12_fill_in_middle"](spark, sf)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[5])
    assert sorted(map(tuple, found.collect()), key=key) == sorted((expected_infill(*r) for r in rows), key=key)
    assert {r.form for r in found.collect()} == {"plain", "psm", "spm"}


def test_op12_of_nothing(spark, folder):
    assert queries.QUERIES["op12_fill_in_middle"](spark, folder("documents", [], "doc_id bigint, text string")).count() == 0


def expected_places(words, templates, index):
    """Every start of every template, by looking at each."""
    out = []
    for t, template in enumerate(templates):
        own = template.words
        for start in range(-len(own), len(words) + 1):
            at = lambda i: words[start + i] if 0 <= start + i < len(words) else None  # noqa: B023, E731
            votes = sum(at(i) == w for w, places in index[t].items() for i in places)
            if votes >= max(1, license_scan.needed(index[t])) and all(at(i) == own[i] for i in template.required):
                out.append((t, template.label, template.base, start, sum(at(i) == w for i, w in enumerate(own)) / len(own)))
    return out


LICENSE = [
    "Released under the MIT License.", "under the under the mit license; under the MIT-License x", "Licensed under CC BY-NC 4.0.", "cc by nc cc by nc",
    "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0.",
    "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions\n# are met:",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this SOFT and associated papers, the Software, to deal in the Software without "
    "restriction", "under the mit", "mit license", "the the mit license", "gnu gnu gnu general public license version 2", "", None, "é under the mit licenseé", "...",
    "any later version " * 3000 + "gnu affero general public license",
]


def test_license_scan(spark):
    rng = random.Random(9)
    vocabulary = sorted({w for t in license_scan.TEMPLATES for w in t.words})
    texts = LICENSE + [" ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(40)]
    for template in license_scan.TEMPLATES:  # whole ones, with an edit, and cut
        words = template.words
        texts += [" ".join(words), " ".join([*words[:2], "EDIT", *words[3:]]), "lead in " + " ".join(words[1:]), " ".join(words[:-1]) + " out"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "cc by nc", "x")], "doc_id bigint, text string, places string").repartition(3)
    found = {r.doc_id: r for r in license_scan.scan(docs.drop("places"), ["doc_id"]).collect()}
    split = [re.findall(license_scan.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    counts = {w: sum(w in s for s in split) + (w in ("cc", "by", "nc")) for w in vocabulary}
    assert license_scan.document_counts(docs, vocabulary) == {w: n for w, n in counts.items() if n}
    index = license_scan.rare_index(license_scan.TEMPLATES, counts)
    for i, words in enumerate(split):
        assert found[i].n_words == len(words)
        assert [tuple(p) for p in found[i].places] == expected_places(words, license_scan.TEMPLATES, index), texts[i]
    assert len(found[None].places) == 1
    for t, template in enumerate(license_scan.TEMPLATES):
        assert (t, 1.0) in {(p.template, p.score) for p in found[len(LICENSE) + 40 + 4 * t].places}


def test_op13(spark, folder):
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    sf = folder("documents", [(i, t, "a", 1) for i, t in enumerate(LICENSE)], "doc_id bigint, text string, label string, _words int")
    found = queries.QUERIES["op13_license_scan"](spark, sf)
    for r in found.collect():
        words = re.findall(license_scan.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), LICENSE[r.doc_id] or ""))
        base = [(i, label) for i in range(len(words)) for p, label in phrases.items() if words[i : i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base) == (len(words), len(base))
        assert (r.first_word, r.last_word) == ((min(base)[0], max(base)[0]) if base else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in base}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_op13_of_nothing(spark, folder):
    assert queries.QUERIES["op13_license_scan"](spark, folder("documents", [], "doc_id bigint, text string")).count() == 0


def test_templates_name_their_phrases():
    with pytest.raises(ValueError):
        license_scan.Template("x", "some words here", ("other words",)).required  # noqa: B018
