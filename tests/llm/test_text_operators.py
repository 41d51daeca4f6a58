"""Decontamination, pseudonyms, line chunks and licences on small made cases."""

import datetime
import hashlib
import random
import re
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripstrata.llm import decontaminate as dc
from tripstrata.llm import licences as lc
from tripstrata.llm import line_chunks as ch
from tripstrata.llm import pseudonyms as ps
from tripstrata.llm import set_join as sj

DOCS = "doc_id long, text string"
WORDS = [f"w{i}" for i in range(30)]
ITEM = " ".join(WORDS[:12])


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def by_key(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# --- Decontamination ---------------------------------------------------------------

@pytest.mark.parametrize("limits", [{}, {"set_windows": 0}, {"set_windows": 0, "broadcast_windows": 0}])
def test_windows_are_found_and_counted(spark, limits):
    bench = frame(spark, [(1, ITEM), (2, ITEM.upper()), (3, "Short item"), (4, ""), (5, None), (6, " ".join(WORDS[2:12]))],
                  "item_id long, text string")
    docs = frame(spark, [
        (1, "start " + " ".join(WORDS[1:11]).title() + ", end"), (2, " ".join(WORDS[:9])), (3, "a short-item b"), (4, None),
        (5, ""), (6, " ".join(WORDS[2:12]) + " x " + " ".join(WORDS[2:12])), (7, "É short, ITEM short item")])
    got = by_key(dc.contamination(docs, bench, **limits))
    assert {k: (r.n_words, r.n_hit, r.n_items, r.contaminated) for k, r in got.items()} == {
        1: (12, 10, 2, True), 2: (9, 0, 0, False), 3: (4, 2, 1, True), 4: (0, 0, 0, False), 5: (0, 0, 0, False),
        6: (21, 20, 3, True), 7: (5, 4, 1, True)}
    assert got[6].items_sha256 == hashlib.sha256(b"1,2,6").hexdigest()
    assert got[2].items_sha256 == hashlib.sha256(b"").hexdigest()


def test_windows_use_only_ascii_case(spark):
    bench = frame(spark, [(1, "é " * 10)], "item_id long, text string")
    got = by_key(dc.contamination(frame(spark, [(1, "É " * 10), (2, "é " * 10)]), bench))
    assert (got[1].n_hit, got[2].n_hit) == (0, 10)


def test_removal_and_clashing_columns(spark):
    bench = frame(spark, [(1, ITEM)], "item_id long, text string")
    docs = frame(spark, [(1, f"Before, {ITEM}! After.", "a", 1), (2, "Nothing here", None, 2), (3, None, "c", 3), (2, "Nothing here", "d", 4)],
                 "doc_id long, text string, words string, item_id int")
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 2, 3]
    cut = {r.item_id: r.text for r in dc.decontaminate(docs, bench, remove="spans").collect()}
    assert cut == {1: "Before, After.", 2: "Nothing here", 3: None, 4: "Nothing here"}


@pytest.mark.parametrize("remove", ["documents", "spans"])
def test_removal_with_null_and_repeated_keys(spark, remove):
    docs = frame(spark, [(None, ITEM, 1), (None, "clean", 2), (4, ITEM, 3), (4, "clean too", 4), (4, None, 5), (None, None, 6)],
                 "doc_id long, text string, n int")
    out = dc.decontaminate(docs, frame(spark, [(1, ITEM)], "item_id long, text string"), remove=remove)
    whole = {2: "clean", 4: "clean too", 5: None, 6: None}
    assert out.columns == docs.columns
    assert {r.n: r.text for r in out.collect()} == (whole if remove == "documents" else {**whole, 1: "", 3: ""})


def test_columns_with_the_names_used_inside(spark):
    """Extra columns called as the operators call their own pass unchanged."""
    names = ["_row", "_gone", "_gone_row", "_hit_row", "_hit_key", "_hit_spans", "_found", "_NEW", "_copies", "_n"]
    lines = "\n".join(" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(i, t, *(f"{n}{i}" for n in names)) for i, t in enumerate([lines + " 8.8.8.8", lines + " 8.8.8.8", ITEM, None])]
    docs = frame(spark, rows, f"{DOCS}, {', '.join(f'{n} string' for n in names)}")
    bench = frame(spark, [(1, ITEM)], "item_id long, text string")
    results = {
        "spans": dc.decontaminate(docs, bench, remove="spans"), "documents": dc.decontaminate(docs, bench),
        "lines": ch.dedup_lines(docs), "values": ps.pseudonymise(docs, KEY), "copies": sj.one_of_each(docs)}
    texts = {}
    for kind, out in results.items():
        assert out.columns[:len(docs.columns)] == docs.columns
        got = out.collect()
        assert all(r[n] == f"{n}{r.doc_id}" for r in got for n in names), kind
        texts[kind] = {r.doc_id: r.text for r in got}
    assert texts["spans"][2] == "" and sorted(texts["documents"]) == [0, 1, 3]
    assert texts["lines"][0] == rows[0][1] and texts["lines"][1] == ""
    assert texts["values"][0] == texts["values"][1] != rows[0][1] and sorted(texts["copies"]) == [0, 2, 3]


def test_empty_benchmark_and_documents(spark):
    bench, docs = frame(spark, [], "item_id long, text string"), frame(spark, [(1, ITEM)])
    assert by_key(dc.contamination(docs, bench))[1].n_hit == 0
    assert dc.contamination(docs.limit(0), frame(spark, [(1, ITEM)], "item_id long, text string")).count() == 0


# --- Pseudonyms --------------------------------------------------------------------

KEY = "k"


def feistel(value, left, right, kind):
    """The network in plain Python."""
    a, b = divmod(value, right)
    for turn in range(ps.ROUNDS):
        other = b if turn % 2 == 0 else a
        f = int(hashlib.sha256(f"{KEY}|{kind}|{turn}|{other}".encode()).hexdigest()[:15], 16)
        if turn % 2 == 0:
            a = (a + f) % left
        else:
            b = (b + f) % right
    return a * right + b


def luhn(digits):
    total = sum(sum(divmod(int(d) * (2 if i % 2 else 1), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def new_texts(spark, texts, invert=False):
    rows = frame(spark, list(enumerate(texts)))
    return [r.text for r in ps.pseudonymise(rows, KEY, invert=invert).orderBy("doc_id").collect()]


def test_networks_equal_plain_python(spark):
    texts = ["8.8.4.255", "2001-02-03", "+1 (212) 555-0199", "123-45-6789", "4111111111111111"]
    ip, date, phone, ssn, card = new_texts(spark, texts)
    moved = feistel((8 << 24) + (8 << 16) + (4 << 8) + 255, 65536, 65536, "ip")
    assert ip == ".".join(str(moved >> s & 255) for s in (24, 16, 8, 0))
    first = datetime.date(1800, 1, 1)
    days = feistel((datetime.date(2001, 2, 3) - first).days, 189, 773, "date")
    assert date == str(first + datetime.timedelta(days))
    number = str(feistel(2125550199 - 2 * 10 ** 9, 80_000, 100_000, "phone") + 2 * 10 ** 9)
    assert phone == f"+1 ({number[:3]}) {number[3:6]}-{number[6:]}"
    n = feistel((123 - 1) * 99 * 9999 + 44 * 9999 + 6788, 898, 99 * 9999, "ssn")
    area, rest = divmod(n, 99 * 9999)
    area += 1 + (area + 1 >= 666)
    assert ssn == f"{area:03}-{rest // 9999 + 1:02}-{rest % 9999 + 1:04}"
    middle = f"{feistel(int('4111111111111111'[1:-1]), 10 ** 7, 10 ** 7, 'card'):014}"
    assert card[:-1] == "4" + middle and luhn(card) and luhn("4111111111111111")


def test_formats_links_and_the_way_back(spark):
    texts = [
        "Call +1 (988) 555-2485 or 212-555-0142.", "Mail Rho.kk73@mail2.example.com, or (rho.kk73@mail2.example.com)",
        "Cards 4111111111111111 and 4111111111111111; 4111111111111112 is none.", "Host 70.214.118.188. Not 70.214.118.288",
        "On 1999-12-31, 31.12.1999, 12/31/1999, 31/12/1999; not 1999-02-30 or 2500-01-01", "", None, "no value", "SSN 123-45-6789; not 000-45-6789",
        "x" * 200_000 + " 8.8.8.8", "a@b.co", "١٢٣ 5.5.5.5"]
    out = new_texts(spark, texts)
    assert out[6] is None and out[5] == "" and out[7] == "no value"
    for old, new in zip(texts, out, strict=True):
        if old and any(c.isdigit() for c in old):
            assert new != old and re.sub(r"[0-9A-Za-z]", "x", new) and len(new) >= len(old) - 12
    cards = re.findall(r"\d{16}", out[2])
    assert cards[0] == cards[1] != "4111111111111111" and luhn(cards[0]) and cards[2] == "4111111111111112"
    assert out[3].endswith("Not 70.214.118.288") and out[4].endswith("not 1999-02-30 or 2500-01-01")
    assert out[8].endswith("000-45-6789")
    iso, dot, us, gb = re.findall(r"[\d./-]{10}", out[4])[:4]
    day = datetime.date.fromisoformat(iso)
    assert (dot, us) == (f"{day:%d.%m.%Y}", f"{day:%m/%d/%Y}") and gb
    assert out[1].count("@mail2.example.com") == 2 and "Rho.kk73" not in out[1]
    assert re.search(r"[A-Z][a-z]{2}\.[a-z]{2}\d\d@", out[1])
    back = new_texts(spark, [t for i, t in enumerate(out) if i != 4], invert=True)
    assert back == [t for i, t in enumerate(texts) if i != 4]


def test_every_written_form_is_replaced(spark):
    texts = ["+44 (020) 555-0199", "+49 (030) 555-0199", "+1 (023) 555-0199", "+1 (123) 555-0199", "+44 (212) 555-0199",
             "(212) 555-0142", "012-345-6789", "4111 1111 1111 1111", "4111-1111-1111-1111", "3782 822463 10005",
             "3782-822463-10005", "4111 1111 1111 1111 003", "2024-01-02T10:00", "2024-01-02T10:00:00Z", "2024-1-2",
             "2024-1-22", "2024-11-2", "1.2.2024", "3/25/2024", "12/5/2024", "a@example.com", "B@example.com",
             "7@example.com", "4111-1111-1111-1112", "2024-2-30", "2024-01-02x"]
    out = new_texts(spark, texts)
    assert out[-3:] == texts[-3:] and all(a != b for a, b in zip(texts[:-3], out[:-3], strict=True)), out
    shape = [re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub(r"\d", "0", x))) for x in texts]
    assert [re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub(r"\d", "0", x))) for x in out] == shape
    assert new_texts(spark, out, invert=True) == texts
    assert [x.split(" ")[0] for x in out[:5]] == ["+44", "+49", "+1", "+1", "+44"]
    assert out[2][4] in "01" and out[3][4] in "01" and out[6][0] in "01" and out[5][1] in "23456789"
    assert all(luhn(re.sub(r"\D", "", x)) for x in out[7:12]) and out[12][10:] == "T10:00" and out[12][:10] == out[13][:10]
    assert re.sub(r"\D", "", out[7]) == re.sub(r"\D", "", out[8]) == new_texts(spark, ["4111111111111111"])[0]
    # Days of one written form go to different days of that form.
    days = [f"{1800 + y}-{m}-{d}" for y in range(0, 400, 40) for m in range(1, 10) for d in range(1, 10)]
    new = new_texts(spark, days)
    assert len(set(new)) == len(days) and all(re.fullmatch(r"\d{4}-[1-9]-[1-9]", x) for x in new)


def test_networks_are_permutations(spark):
    values = spark.range(20 * 33).select("id", ps.feistel(F.col("id"), ps.long(20), ps.long(33), KEY, "x").alias("p"))
    back = values.select("id", "p", ps.feistel(F.col("p"), ps.long(20), ps.long(33), KEY, "x", invert=True).alias("b")).collect()
    assert sorted(r.p for r in back) == list(range(660)) and all(r.b == r.id for r in back)


def test_pseudonyms_keep_columns(spark):
    docs = frame(spark, [(1, "8.8.8.8", "x", 5)], "doc_id long, text string, _kind string, n_chars long")
    out = ps.pseudonymise(docs, KEY)
    assert out.columns[:4] == docs.columns and out.first().n_ip == 1
    assert ps.pseudonymise(docs.limit(0), KEY).count() == 0


# --- Line chunks -------------------------------------------------------------------

def chunks_in_python(lines):
    """(first, last) of the chunks, from 0, by the definition."""
    hashes = [int(hashlib.md5(s.encode()).hexdigest()[:8], 16) for s in lines]
    counts = [len([w for w in s.split(" ") if w]) for s in lines]
    rolled = {i: (hashes[i - 1] * ch.BASE + hashes[i]) % ch.PRIME for i in range(1, len(lines))
              if max(counts[i - 1:i + 1]) < ch.LONG_LINE and sum(counts[i - 1:i + 1]) >= ch.LEAST_WORDS}
    out = [(i, i) for i, n in enumerate(counts) if n >= ch.LONG_LINE]
    for i, own in rolled.items():
        beside = [rolled.get(i - 1), rolled.get(i + 1)]
        if None in beside or own <= max(beside) or sum(counts[i - 1:i + 1]) >= ch.LONG_LINE:
            out.append((i - 1, i))
    return sorted(out)


def cut_in_python(docs):
    """(doc_id, text without later copies) by the definition, for sorted documents."""
    texts = {key: text.split("\n") for key, text in docs if text is not None}
    cut = {key: chunks_in_python(lines) for key, lines in texts.items()}

    def body(key, span):
        return "\n".join(texts[key][span[0]:span[1] + 1])

    times = Counter(body(key, span) for key, spans in cut.items() for span in spans)
    asked = set()
    for key, spans in cut.items():
        own = [span for span in spans if times[body(key, span)] > 1]
        for first, last in own:
            asked.add((key, first, last))
            if first > 0:
                asked.add((key, first - 1, last))
            if last + 1 < len(texts[key]):
                asked.add((key, first, last + 1))
    seen, gone = set(), set()
    for key, first, last in sorted(asked):
        if body(key, (first, last)) in seen:
            gone |= {(key, i) for i in range(first, last + 1)}
        seen.add(body(key, (first, last)))
    return {key: None if text is None else "\n".join(s for i, s in enumerate(texts[key]) if (key, i) not in gone)
            for key, text in docs}


def line(n, words=8):
    return " ".join(f"l{n}x{k}" for k in range(words))


def test_repeated_chunks_go_and_shifts_do_not_matter(spark):
    passage = [line(n) for n in range(100, 112)]
    rows = [(n, "\n".join([*(line(1000 * n + k) for k in range(n % 5)), *passage, line(7000 + n)])) for n in range(12)]
    rows += [(20, line(1, 60)), (21, "before\n" + line(1, 60) + "\nafter"), (22, None), (23, ""), (24, "\n\n"), (25, ""),
             (26, "\n".join(passage + passage)), (27, line(2, 3) + "\n" + line(3, 3)), (28, line(2, 3) + "\n" + line(3, 3))]
    got = {r.doc_id: r.text for r in ch.dedup_lines(frame(spark, rows)).collect()}
    assert got == cut_in_python(rows)
    assert got[20] == rows[12][1] and line(1, 60) not in got[21] and got[28] == rows[-1][1]
    assert all(len(got[n]) < len(rows[n][1]) - 300 for n in range(1, 12)) and got[0] == rows[0][1]


def test_shared_passages_go_whole_wherever_they_stand(spark):
    draw = random.Random(7)
    rows, planted = [], {}
    for n in range(300):
        size = draw.choice([1, 2, 3, 4, 5, 8])
        least = -(-ch.LONG_LINE // size)
        passage = [line(f"p{n}k{k}", draw.randint(max(6, least), max(6, least) + 9)) for k in range(size)]
        for copy in range(3):
            around = [[line(f"o{n}c{copy}s{side}k{k}", draw.choice([0, 1, 4, 9, 30, 70])) for k in range(draw.randint(0, 6))]
                      for side in range(2)]
            rows.append((3 * n + copy, "\n".join([*around[0], *passage, *around[1]])))
            planted[3 * n + copy] = passage, around
    got = {r.doc_id: r.text for r in ch.dedup_lines(frame(spark, rows)).collect()}
    assert got == cut_in_python(rows)
    whole = [key for key, (passage, _) in planted.items() if key % 3 and not set(passage) & set(got[key].split("\n"))]
    assert len(whole) == 600  # all later copies, none of a first one
    assert all(got[key] == text for key, text in rows if key % 3 == 0)
    for key, (passage, around) in planted.items():
        assert [s for s in got[key].split("\n") if s not in passage and s] == [s for side in around for s in side if s]


def test_lines_that_repeat_on_the_spot_and_periods(spark):
    same, other = line(1), line(2)
    rows = [(1, "\n".join([same] * 7)), (2, "\n".join([same, other] * 6)), (3, "\n".join([same, other])),
            (4, "\n".join([line(3, 60)] * 3 + [same])), (5, "\n".join(["", line(3, 60), "", ""])), (6, same), (7, other)]
    got = {r.doc_id: r.text for r in ch.dedup_lines(frame(spark, rows)).collect()}
    assert got == cut_in_python(rows) and got[1] == same and got[6] == same and got[3] == ""


def test_rows_that_share_a_key(spark):
    text = "\n".join(line(n) for n in range(20))
    docs = frame(spark, [(1, text, "a", 1), (1, text, "b", 2), (1, text + "\nmore", "c", 3), (2, "x", None, 4)],
                 "doc_id long, text string, row string, last int")
    out = ch.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    got = {r["last"]: (r.text, r.n_removed) for r in out.collect()}
    assert got[4] == ("x", 0) and got[1] == got[2]
    assert sorted(n > 0 for _, n in (got[1], got[3])) == [False, True]  # one of the two texts stays whole
    assert ch.dedup_lines(docs.limit(0)).count() == 0


def test_very_long_text(spark):
    text = "\n".join(line(n % 5000, 4) for n in range(20_000))
    got = ch.dedup_lines(frame(spark, [(1, text)])).first()
    assert got.text == cut_in_python([(1, text)])[1]


# --- Licences ----------------------------------------------------------------------

def test_every_sentence_and_rule_is_found(spark):
    known = {lc.normal(s) for s in lc.SENTENCES.values()}
    assert all(any(a in s.lower() for a in lc.ANCHORS) for s in lc.SENTENCES.values()) and known == set(lc.KNOWN)
    rows = [(n, "\n".join(lc.SENTENCES[i] for i in ids)) for n, (_, _, ids) in enumerate(lc.RULES)]
    got = by_key(lc.scan_licences(frame(spark, rows)))
    for n, (name, _, _) in enumerate(lc.RULES):
        assert name in got[n].licences.split(","), (name, got[n])


def test_order_and_gaps_count(spark):
    grant, keep, as_is = (lc.SENTENCES[f"mit-{k}"] for k in ("grant", "keep", "as-is"))
    rows = [(1, f"{grant} {keep} {as_is}"), (2, f"{keep}\n{grant}\n{as_is}"), (3, f"{grant}\nSome. Text.\n{keep} More.\n{as_is}"),
            (4, f"{grant}\nA. B. C. D. E.\n{keep}\n{as_is}"), (5, None), (6, ""), (7, "a licence of my own"),
            (8, "ALL RIGHTS RESERVED\r\nreleased under the mit license!"), (9, "All rights reserved. All rights reserved.")]
    got = {k: (r.n_known, r.licences, r.category) for k, r in by_key(lc.scan_licences(frame(spark, rows))).items()}
    assert got == {1: (3, "MIT", "permissive"), 2: (3, "", "none"), 3: (3, "MIT", "permissive"), 4: (3, "", "none"),
                   5: (0, "", "none"), 6: (0, "", "none"), 7: (0, "", "none"), 8: (2, "MIT,Proprietary", "restricted"),
                   9: (2, "Proprietary", "restricted")}
    assert lc.scan_licences(frame(spark, [])).count() == 0


def test_wrapped_sentences_are_found(spark):
    def wrapped(ids, lead=""):
        return "\n\n".join(textwrap.fill(lc.SENTENCES[i], 72, initial_indent=lead, subsequent_indent=lead) for i in ids)

    leads = ["", " * ", "// ", "# ", "REM ", "dnl "]
    rows = [(len(leads) * n + k, wrapped(ids, lead)) for n, (_, _, ids) in enumerate(lc.RULES) for k, lead in enumerate(leads)]
    got = by_key(lc.scan_licences(frame(spark, rows)))
    for n, (name, _, ids) in enumerate(lc.RULES):
        for k in range(len(leads)):
            row = got[len(leads) * n + k]
            assert name in row.licences.split(",") and row.n_known == len(ids), (name, leads[k], row)


def test_wrapped_files(spark):
    apache = """/*
 * Copyright 2020 A. Person
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */
"""
    grant, keep, as_is = (textwrap.fill(lc.SENTENCES[f"mit-{k}"], 72) for k in ("grant", "keep", "as-is"))
    other = textwrap.fill("a sentence of our own that nobody knows " * 8, 72) + "."
    half = len(grant) // 2
    rows = [(1, apache), (2, apache.replace("\n", "\r\n")), (3, f"MIT License\n{grant}\n{keep}\n{as_is}"),
            (4, f"{grant}\n\n{other}\n\n{keep}\n{as_is}"), (5, "All rights\n# reserved."), (6, "All rights\n\nreserved."),
            (7, f"{grant[:half].rsplit(' ', 1)[0]}\n\n{grant[half:]}\n{keep}\n{as_is}"), (8, "\n" * 100_000 + "MIT License")]
    got = {k: (r.n_known, r.licences) for k, r in by_key(lc.scan_licences(frame(spark, rows))).items()}
    assert got == {1: (4, "Apache-2.0"), 2: (4, "Apache-2.0"), 3: (4, "MIT"), 4: (3, "MIT"), 5: (1, "Proprietary"),
                   6: (0, ""), 7: (2, ""), 8: (1, "")}
