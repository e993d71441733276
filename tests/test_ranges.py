"""Files read in many small ranges against whole parses."""

import csv
import io
import json
import random

import pyarrow as pa
import pytest

from recordloom.sources.csv_ranges import HeaderMismatch, read_records
from recordloom.sources.json_ranges import read_array
from recordloom.sources.xml_ranges import read_elements


@pytest.fixture
def small_ranges(spark):
    """Splits of the given number of bytes."""

    def set_to(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", f"{n}b")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def element(rng):
    text = lambda: "".join(rng.choice('a}{"\\],[é漢😀\n: ') for _ in range(rng.randrange(12)))
    return rng.choice([
        {"id": rng.randrange(99), "name": {"first": text(), "last": [text(), {}]}, "employees": [1, {"x": "}"}]},
        {"id": text()}, text(), None, 5, [1, [2, {"a": "}"}]], {}, [], True, 1.5,
    ])


def elements_of(got):
    return [json.loads(r.element) for r in got.elements.orderBy("_file", "_block", "_pos").collect()]


@pytest.mark.parametrize("size", [60, 100_000])
def test_json_in_ranges_equals_the_whole_parse(spark, small_ranges, tmp_path, size):
    rng = random.Random(size)
    want = {}
    for n in range(4):
        doc = {"meta": {"employees": [{"no": 1}], "t": '"employees": ['}, "employees": [element(rng) for _ in range(rng.randrange(9))],
               "total_records": 40, "more": [{"a": "}"}]}
        if n == 1:
            doc = {"total_records": 3, "employees": []}
        text = json.dumps(doc, ensure_ascii=n % 2 == 0, indent=n or None) + "\n" * (n % 3)
        (tmp_path / f"{n}.json").write_text(text, encoding="utf-8")
        want[f"{n}.json"] = json.loads(text)
    small_ranges(size)
    got = read_array(spark, str(tmp_path), "employees", "total_records bigint")
    assert elements_of(got) == [e for n in sorted(want) for e in want[n]["employees"]]
    docs = {r["_file"].split("/")[-1]: r for r in got.docs.collect()}
    assert {n: (r.total_records, r.actual_records, r.readable) for n, r in docs.items()} == {
        n: (d["total_records"], len(d["employees"]), True) for n, d in want.items()}


def test_one_document_is_read_by_many_tasks(spark, small_ranges, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps({"employees": [{"i": i, "t": "x" * 50} for i in range(500)]}))
    small_ranges(2000)
    got = read_array(spark, str(tmp_path / "one.json"), "employees", "total_records bigint")
    assert [e["i"] for e in elements_of(got)] == list(range(500))
    assert got.elements.select("_block").distinct().count() > 10


BAD = [
    "", "[]", "{}", '{"employees": 5}', '{"employees": {"a": 1}}', '{"employees": [1, 2', '{"employees": [{"a": 1}', '{"employees": [{"a": 1}]',
    '{"employees": [1,]}', '{"employees": [,1]}', '{"employees": [{"a" 1}]}', '{"employees": [1]}}', '{"employees": [1], "x": nope}', "no json",
    '{"employees": ["\\x"]}', '{"other": [{"employees": [1]}]}', '{"employees": [{"a": 1}], "total_records": 1']


def test_documents_that_a_whole_parse_refuses(spark, small_ranges, tmp_path):
    for n, text in enumerate(BAD):
        (tmp_path / f"bad{n}.json").write_text(text)
    (tmp_path / "good.json").write_text('{"employees": [{"a": 1}, 2]}')
    small_ranges(25)
    got = read_array(spark, str(tmp_path), "employees", "total_records bigint")
    assert elements_of(got) == [{"a": 1}, 2]
    readable = {r["_file"].split("/")[-1]: r.readable for r in got.docs.collect()}
    assert len(readable) == len(BAD) + 1 and [f for f, good in readable.items() if good] == ["good.json"]


def made_csv(rng, rows):
    out = io.StringIO()
    write = csv.writer(out, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), lineterminator=rng.choice(["\n", "\r\n"]))
    write.writerow(["a", "b", "c"])
    for _ in range(rows):
        write.writerow(["".join(rng.choice(',"\nxé y') for _ in range(rng.randrange(9))) + "." for _ in range(3)])
    return out.getvalue()


@pytest.mark.parametrize("size", [60, 100_000])
def test_csv_in_ranges_equals_the_whole_parse(spark, small_ranges, tmp_path, size):
    rng = random.Random(size)
    want = []
    for n in range(4):
        text = made_csv(rng, 12)
        (tmp_path / f"{n}.csv").write_bytes(text.encode())
        want += list(csv.reader(io.StringIO(text, newline="")))[1:]
    (tmp_path / "9.csv").write_text('a,b,c\n\n1,5" pipe,"q"x"\n"open,2')
    want += [["1", '5" pipe', None]]
    small_ranges(size)
    got = read_records(spark, str(tmp_path))
    assert got.names == ["a", "b", "c"]
    rows = got.rows.orderBy("_pos.file", "_pos.block", "_pos.row").collect()
    assert [list(r)[:2] for r in rows[:-2]] == [w[:2] for w in want[:-1]]
    assert [r.c for r in rows[:-2]] == [w[2] for w in want[:-1]]
    assert rows[-2].b == '5" pipe' and rows[-2].too_long is False
    assert rows[-1].line == '"open,2' and rows[-1].too_long is True
    assert not any(r.too_long for r in rows[:-1])


def test_csv_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,,x,y\n1,2,3,4\n")
    assert read_records(spark, str(tmp_path)).names == ["x", "_c1", "x2", "y"]
    (tmp_path / "b.csv").write_text("x,,y,x\n1,2,3,4\n")
    with pytest.raises(HeaderMismatch, match="header"):
        read_records(spark, str(tmp_path))


def test_xml_in_ranges(spark, small_ranges, tmp_path):
    one = lambda i, more="": f"<enrollment a='1'><employee_id> {i} </employee_id><plan_type>P&amp;{i}</plan_type>{more}</enrollment>\n"
    (tmp_path / "a.xml").write_text("<?xml version='1.0'?>\n<benefits>" + "".join(one(i, "<extra>é</extra>" if i == 3 else "") for i in range(20)) + "<enrollment/></benefits>")
    (tmp_path / "b.xml").write_text("<benefits>" + one(77) + "<enrollment><employee_id>4</empl")
    (tmp_path / "c.xml").write_text("<benefits>" + one(78) + one(79, "<a><b></a>") + "</benefits>")
    (tmp_path / "d.xml").write_text("<benefits>" + one(80))
    small_ranges(90)
    got = read_elements(spark, str(tmp_path), "enrollment")
    rows = got.rows.orderBy("_pos.file", "_pos.block", "_pos.row").collect()
    assert [r.record.get("employee_id") for r in rows] == [*map(str, range(20)), None]
    assert rows[3].record == {"employee_id": "3", "plan_type": "P&3", "extra": "é"} and rows[20].record == {}
    assert sorted(f.split("/")[-1] for f in got.broken) == ["b.xml", "c.xml", "d.xml"]


_FIELDS = ("employee_id", "plan_type")


def _xml_rows(pieces):
    from recordloom.sources.xml_ranges import _pieces_to_rows

    n = len(pieces)
    batch = pa.RecordBatch.from_pydict({"piece": pa.array(pieces, pa.binary()), "file": pa.array(["f"] * n), "block": pa.array([0] * n, pa.int64()), "size": pa.array([9] * n, pa.int64())})
    return [r for out in _pieces_to_rows("enrollment", _FIELDS)(iter([batch])) for r in out.to_pylist()]


def test_xml_plain_elements_need_no_parser(monkeypatch):
    import recordloom.sources.xml_ranges as xml

    monkeypatch.setattr(xml.ET, "fromstring", lambda text: pytest.fail("parsed: " + text))
    rows = _xml_rows([b"\n<enrollment><employee_id> 1 </employee_id>\n<plan_type></plan_type></enrollment>"[:-13], b"<enrollment><plan_type>x</plan_type><more>\xc3\xa9</more>"])
    assert [(r["plain"], r["f_employee_id"], r["f_plan_type"], r["record"]) for r in rows] == [(True, "1", None, None), (False, None, None, [("plan_type", "x"), ("more", "é")])]


def test_xml_without_parser_equals_parser():
    import xml.etree.ElementTree as ET

    bodies = ["", " ", "t", "a&amp;b", "a&b", "a<b", "a>b", "]]>", "\x00", "\x1f", "\r x\r\ny", "\x7f", "\u0085x\u00a0", "\ufffe", "\uffff", "<b>1</b>", "<!-- c -->x", "<![CDATA[x]]>", "é\U0001f600", "\u2028"]
    shapes = ["<employee_id>{}</employee_id><plan_type>p</plan_type>", "<plan_type>p</plan_type> <employee_id>{}</employee_id>", "<employee_id>1</employee_id><plan_type>p</plan_type><employee_id>{}</employee_id>",
              "<employee_id a='1'>{}</employee_id>", "<a:b>{}</a:b>", "<é>{}</é>", "<a>1</a>{}", "<a>{}</b>", "<1a>{}</1a>", "<a/>{}", "<enrollment>{}"]
    pieces = [f"<enrollment>{shape.format(body)}" for shape in shapes for body in bodies]
    rows = iter(_xml_rows([p.encode("utf-8") for p in pieces]))
    for piece in pieces:
        row = next(rows)
        got = dict(zip(_FIELDS, (row["f_employee_id"], row["f_plan_type"]))) if row["plain"] else row["record"] if row["record"] is None else dict(row["record"])
        try:
            element = ET.fromstring(piece + "</enrollment>")
            wanted, broken = {c.tag: (c.text or "").strip() or None for c in element}, element.find(".//enrollment") is not None
        except ET.ParseError:
            wanted, broken = None, True
        assert (got, list(got or ()), row["broken"]) == (wanted, list(wanted or ()), broken), piece
    assert next(rows, None) is None


def test_xml_fields_beside_records(spark, tmp_path):
    (tmp_path / "a.xml").write_text(
        "<benefits><enrollment><employee_id>1</employee_id><plan_type>p</plan_type></enrollment><enrollment><plan_type>q&amp;</plan_type></enrollment>"
        "<enrollment><employee_id>2</employee_id><plan_type/><more>x</more></enrollment></benefits>"
    )
    rows = read_elements(spark, str(tmp_path), "enrollment", fields=_FIELDS).rows.orderBy("_pos.row").collect()
    assert [r.record for r in rows] == [{"employee_id": "1", "plan_type": "p"}, {"plan_type": "q&"}, {"employee_id": "2", "plan_type": None, "more": "x"}]
    assert [(r.f_employee_id, r.f_plan_type, r.has_employee_id, r.has_plan_type) for r in rows] == [("1", "p", True, True), (None, "q&", False, True), ("2", None, True, True)]


def test_xml_much_outside_the_elements(spark, tmp_path):
    one = "<enrollment><employee_id>{}</employee_id><plan_type>p</plan_type></enrollment>"
    more = "<note>" + "é" * 99_983 + "</note>\n"
    body = "".join(one.format(i) + more for i in range(340))  # 68 MB
    (tmp_path / "a.xml").write_text("<?xml version='1.0'?><benefits>" + body + "</benefits>", "utf-8")
    (tmp_path / "b.xml").write_text("<benefits>" + body + "</note></benefits>", "utf-8")
    got = read_elements(spark, str(tmp_path), "enrollment", fields=_FIELDS)
    assert [f.split("/")[-1] for f in got.broken] == ["b.xml"]
    assert sorted(int(r.f_employee_id) for r in got.rows.collect()) == list(range(340))


def test_xml_document_in_parts():
    import xml.etree.ElementTree as ET

    from recordloom.sources.xml_ranges import _documents

    texts = ["", " ", "<a/>", "<a>", "<a/><b/>", "﻿<a/>", "﻿﻿<a/>", "﻿<?xml version='1.0'?><a>é</a>", "﻿﻿<?xml version='1.0'?><a/>", "<?xml version='1.0' encoding='latin-1'?><a>é</a>",
             "<?xml version='1.0' encoding='utf-16'?><a/>", "<?xml version='1.0' encoding='none-such'?><a/>", " <?xml version='1.0'?><a/>", "<!DOCTYPE a [<!ENTITY e 'x'>]><a>&e;</a>", "<a>&e;</a>", "<a><![CDATA[<]]><!-- \U0001f600 --></a>", "<a b='1' b='2'/>", "<b:a/>", "<a>\x00</a>", "<?xm"]

    def wanted(text):
        plain = text.lstrip("﻿")
        try:
            ET.fromstring(plain.encode() if plain.startswith("<?xml") else text)
            return True
        except (ET.ParseError, LookupError):
            return False

    for step in (1, 3, 1000):
        rows = [(str(n), text[k : k + step]) for n, text in enumerate(texts) for k in range(0, len(text) or 1, step)]
        batches = [pa.RecordBatch.from_pydict({"file": [r[0] for r in part], "outside": [r[1] for r in part]}) for part in (rows[:7], rows[7:])]
        told = {r["file"]: r["whole"] for out in _documents(iter(batches)) for r in out.to_pylist()}
        assert told == {str(n): wanted(text) for n, text in enumerate(texts)}
