from __future__ import annotations

import hashlib
import itertools
import re

import pytest
from pyspark.sql import functions as F

from trailperks.llm import pii
from trailperks.llm.queries import op3

SMALL = "/root/testdata/sf0.001"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def plain(text):
    """The contract's patterns as they stand."""
    text, out = text or "", []

    def luhn(digits):
        doubled = [int(d) if n % 2 == 0 else sum(divmod(2 * int(d), 10)) for n, d in enumerate(digits[::-1])]
        return sum(doubled) % 10 == 0

    out += [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    out += [("ip", *m.span()) for m in re.finditer(IP, text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(CARD, text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(PHONE, text) if 10 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


HARD = [
    None, "", "a@b.c@d.e", "a@b@c.d", "@x.y", "x@y", "x@y.", "..@-.-", "é@b.co", "me@site.co.uk.", "a@b.c.d@e.f", "1@2.3.4.5",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "1.1.1.256 1.1.1.255", "001.002.0003.4", "1.2.3", "9999.1.2.3.4", "0000000001.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111", "4111  1111 1111 1111", "41111111111111111111", "4111 1111 1111 1112",
    "+1 (988) 555-2485", "+1 2", "+12345678901234567", "+1-(555)..0000000) ", "++4912345678901", "+49 4111 1111 1111 1111", "+4111111111111111",
    "5 - 4111111111111111", "\U0001f600 a@b.co é 1.2.3.4", "1" * 5000, "a" * 5000, "a@" * 2000, "+1" + "(" * 3000,
]


@pytest.mark.parametrize("text", HARD, ids=range(len(HARD)))
def test_base_spans(text):
    assert pii.base_spans(text or "") == plain(text)


def test_random_base_spans():
    import random

    pick = random.Random(4)
    for _ in range(4000):
        text = "".join(pick.choice("0123456789..@-+ ab()41") for _ in range(pick.randrange(40)))
        assert pii.base_spans(text) == plain(text), text


def test_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op3(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        spans = plain(texts[row.doc_id])
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[0] == k for s in spans) for k in pii.KINDS[:4]]
        assert set(written.split(",")) <= set(row.spans.split(","))


def corpus():
    """'quaxley' stands only near one address, 'the' everywhere, 'halfway' also elsewhere."""
    rows = [(n, f"the plain words number{n} go here and the end") for n in range(300)]
    for n in range(300, 305):
        rows.append((n, f"filler{n} the Quaxley halfway mail Joe@site.com and other{n} words the end"))
    rows += [(n, f"the halfway line{n}") for n in range(400, 440)]
    return rows


def counted_disclosure(rows, entity, term, near):
    words = [set(re.findall(r"\w+", t.lower())) for _, t in rows]
    of_entity = sum(entity in t.lower() for _, t in rows)
    return pii.disclosure(len(rows), of_entity, sum(term in w for w in words), near)


def test_disclosing_terms(documents):
    rows = corpus()
    assert counted_disclosure(rows, "joe@site.com", "quaxley", 5) >= pii.REMOVE
    assert counted_disclosure(rows, "joe@site.com", "the", 5) < pii.GENERALISE
    got = {r.row.doc_id: r for r in pii.protect(documents(rows)).collect()}
    assert len(got) == len(rows)
    hit = got[300]
    start = rows[300][1].index("Quaxley")
    assert [(s.kind, s.start, s.end) for s in hit.spans if s.kind == "term"][0] == ("term", start, start + 7)
    assert "Quaxley" not in hit.sanitised and "Joe" not in hit.sanitised and "[EMAIL]" in hit.sanitised and "the end" in hit.sanitised
    assert all(got[n].sanitised == t for n, t in rows if n < 300 or n >= 400)


def test_disclosing_terms_are_hidden_everywhere(documents):
    """Also far from the entity, and in documents without it."""
    rows = [(n, f"plain words number{n}") for n in range(300)]
    rows += [(n, f"a{n} Quaxley mail joe@site.com b{n} " + "plain " * 30 + "quaxley ends") for n in range(300, 310)]
    rows.append((310, "alone QUAXLEY here"))
    got = {r.row.doc_id: r.sanitised for r in pii.protect(documents(rows)).collect()}
    assert not [d for d, text in got.items() if "quaxley" in text.lower()]
    assert got[310].startswith("alone ") and got[310].endswith(" here") and got[5] == "plain words number5"


def test_terms_far_from_the_entity_disclose_it(documents):
    """The name heads the text, the address ends it; long terms count too."""
    rows = [(n, f"plain words number{n}") for n in range(300)]
    rows += [(n, f"Quaxley {'long' * 300} a{n} " + "plain words " * 90 + "joe@site.com") for n in range(300, 310)]
    for row in pii.protect(documents(rows)).collect():
        assert "Quaxley" not in row.sanitised and "long" not in row.sanitised
        assert [s.kind for s in row.spans] == (["term", "term", "email"] if row.row.doc_id >= 300 else [])


def test_rare_entities(documents):
    """Found in two texts; a rare word of the only text with an entity is a coincidence, as the corpus has many rare words."""
    rows = [(n, f"plain words number{n}") for n in range(3000)]
    rows += [(4000 + n, f"plain Quaxley words x{n} plain joe@site.com") for n in range(2)]
    rows.append((4020, " ".join(f"only{n}" for n in range(100)) + " bob@site.com"))
    got = {r.row.doc_id: r.sanitised for r in pii.protect(documents(rows)).collect()}
    assert "Quaxley" not in got[4000] + got[4001] and "plain" in got[4000] and got[5] == "plain words number5"
    assert got[4020] == rows[-1][1].replace("bob@site.com", "[EMAIL]")


def test_entity_found_once(documents):
    """Among many texts of few words, one text is evidence."""
    rows = [(n, " ".join(words)) for n, words in enumerate(itertools.product(["one", "two", "three", "four"], repeat=6))]
    rows.append((5000, "one Brimble ann@site.com"))
    assert [r.sanitised for r in pii.protect(documents(rows)).where("row.doc_id = 5000").collect()] == ["one  [EMAIL]"]


def test_entity_of_every_text(documents):
    rows = [(n, f"some{n} words joe@site.com") for n in range(40)]
    assert all(r.sanitised == t.replace("joe@site.com", "[EMAIL]") for r, (_, t) in zip(pii.protect(documents(rows)).orderBy("row.doc_id").collect(), rows))


def test_free_terms():
    text = "Ab1 x1.2.3.4 _cd_ joe@site.com,End"
    assert list(pii.free_terms(text, pii.base_spans(text))) == [("ab1", 0, 3), ("cd", 14, 16), ("end", 31, 34)]


def test_copies_are_no_evidence(documents):
    rows = [(n, "once Quaxley wrote from joe@site.com to all") for n in range(30)] + [(n, f"the text{n}") for n in range(50, 90)]
    assert all(s.kind != "term" for r in pii.protect(documents(rows)).collect() for s in r.spans)


def test_defined_results(documents):
    docs = documents([(None, "a@b.co"), (1, None), (2, ""), (2, "a@b.co x"), (2, "a@b.co x"), (3, "y " * 200000 + "1.2.3.4")])
    docs = docs.withColumn("spans", F.lit("clash")).withColumn("hits", F.lit(1)).withColumn("doc", F.lit("x"))
    got = sorted(((str(r.row.doc_id), r.sanitised and r.sanitised[-9:], len(r.spans)) for r in pii.protect(docs).collect()), key=str)
    assert got == sorted(
        [("None", "[EMAIL]", 1), ("1", None, 0), ("2", "", 0), ("2", "[EMAIL] x", 1), ("2", "[EMAIL] x", 1), ("3", " y y [IP]", 1)],
        key=str,
    )
    assert pii.protect(docs.where("false")).count() == 0
    assert pii.protect(docs).first()["row"]["lang"] == "en"


def test_overlapping_spans():
    text = "+49 4111 1111 1111 1111 x"
    spans = [("phone", 0, 12), ("card", 4, 23)]
    assert pii.sanitise(text, spans, set()) == "[PHONE] x"
    assert pii.sanitise("a bc d", [("term", 2, 4)], {(2, 4)}) == "a  d"


def test_held_and_joined_terms_hide_alike(documents, monkeypatch):
    rows = [(n, f"plain words number{n} +49 151 2345678{n % 10}") for n in range(300)]
    rows += [(n, f"a{n} Quaxley Éloïse mail joe@site.com b{n} quaxley") for n in range(300, 310)]
    rows += [(310, "alone QUAXLEY here"), (310, "alone QUAXLEY here"), (None, "éloïse"), (311, None)]
    docs = documents(rows)
    found = {}
    for limit in (pii.HELD_BYTES, -1):
        monkeypatch.setattr(pii, "HELD_BYTES", limit)
        result = pii.protect(docs)
        found[limit] = sorted((str(r.row.doc_id), str(r.sanitised), str(r.spans)) for r in result.collect())
        assert "hits" in result._jdf.queryExecution().analyzed().toString() or limit >= 0
    one, other = found.values()
    assert one == other and not any("quaxley" in text.lower() for _, text, _ in one)


def test_places_are_those_of_all_terms():
    pick = __import__("random").Random(6)
    for _ in range(400):
        words = ["ab", "a", "abab", "É", "éa", "x1", "joe@site.com", "1.2.3.4", "_", "-", "ⅷ", "٣", "½", "á", "日本", "b"]
        text = "".join(pick.choice(words) + pick.choice(["", " ", "", ".", ","]) for _ in range(30))
        spans = pii.base_spans(text)
        every = sorted(pii.free_terms(text, spans), key=lambda x: x[1])
        terms = {term for term, _, _ in every if pick.random() < 0.6}
        found = sorted(pii.places_of(terms, text, spans), key=lambda x: x[1])
        assert found == [x for x in every if x[0] in terms]
