import io
import zipfile

import pytest
from pyspark.sql import functions as F

from inkveil.plans import pieces
from inkveil.sinks import packages as sink
from inkveil.sinks import reports as report_sink
from inkveil.sources import lists, packages

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def run(*texts):
    return "".join(f"<w:r><w:rPr><w:b/></w:rPr><w:t xml:space='preserve'>{t}</w:t></w:r>" for t in texts)


BODY = f"""
<w:p>{run('Leand', 'ro Con')}<w:proofErr w:type="x"/>{run('tini &amp; C.')}</w:p>
<w:p><w:sdt><w:sdtContent>{run('Contini ')}</w:sdtContent></w:sdt><w:smartTag>{run('Leandro')}</w:smartTag></w:p>
<w:p>{run('Leandro ')}<w:hyperlink>{run('Contini Leandro')}</w:hyperlink>{run('Contini')}</w:p>
<w:tbl><w:tr>
 <w:tc><w:tcPr/><w:p>{run('Contini')}</w:p></w:tc>
 <w:tc><w:p>{run('Leandro')}</w:p><w:p>{run('x')}</w:p></w:tc>
</w:tr></w:tbl>
<w:p><w:ins>{run('Leandro')}</w:ins>{run(' Contini')}</w:p>
<w:p><w:r><w:t>Leandro</w:t><w:tab/><w:t>Contini</w:t><w:drawing/><w:t>fine</w:t></w:r></w:p>
"""


def document(body, tag="document"):
    return (
        f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n<w:{tag} xmlns:w="{W}" '
        f'xmlns:z="urn:unused">{body}</w:{tag}>'
    ).encode()


def package(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in parts.items():
            z.writestr(name, data)
    return out.getvalue()


@pytest.fixture
def folder(tmp_path):
    first = package(
        {
            "word/document.xml": document(BODY),
            "word/header1.xml": document(f"<w:p>{run('Mario Leandro', ' Contini')}</w:p>", "hdr"),
            "word/styles.xml": document(f"<w:p>{run('Leandro Contini')}</w:p>", "styles"),
        }
    )
    second = package({"word/document.xml": document(f"<w:p>{run('nulla qui')}</w:p>")})
    (tmp_path / "a.docx").write_bytes(first)
    (tmp_path / "b.docx").write_bytes(second)
    (tmp_path / "c.txt").write_text("Leandro Contini")
    return tmp_path


def blocks_of(files):
    return pieces.package_pieces(files)


def whole(table, text="text"):
    out = {}
    for r in table.collect():
        out.setdefault((r.doc_id, r.block_idx), []).append((r.piece, r[text]))
    return {k: "".join(t for _, t in sorted(v)) for k, v in out.items()}


def test_blocks_of_a_package(spark, folder):
    files = packages.read_packages(spark, str(folder))
    assert files.count() == 2
    texts = whole(blocks_of(files))
    mine = [t for (d, i), t in sorted(texts.items(), key=lambda x: x[0]) if d.endswith("a.docx")]
    assert mine == [
        "Leandro Contini & C.",
        "Contini Leandro",
        "Leandro ",
        "Contini Leandro",
        "Contini",
        "\tContini\t\t\tLeandro\tx\t\t",
        "Leandro",
        " Contini",
        "Leandro\tContini",
        "fine",
        "Mario Leandro Contini",
    ]


def test_story_parts_can_be_chosen(spark, folder):
    files = packages.read_packages(spark, str(folder))
    only = packages.nodes(files, ("header",))
    assert {r.part for r in only.select("part").distinct().collect()} == {"word/header1.xml"}


def test_rewritten_package(spark, folder, lines, tmp_path):
    files = packages.read_packages(spark, str(folder))
    people = lists.parse_people(lines("Leandro:Mario;Contini"))
    new_files, job = pieces.redact_packages(files, people=people)
    out = tmp_path / "out"
    sink.write_packages(new_files, str(out))
    assert {tuple(r) for r in job.redaction.frequencies().collect()} == {("Leandro", 6)}
    assert sorted(p.name for p in out.iterdir()) == ["a-result.docx", "b-result.docx"]
    assert (out / "b-result.docx").read_bytes() != b""

    with zipfile.ZipFile(out / "a-result.docx") as z:
        new = z.read("word/document.xml").decode()
        header = z.read("word/header1.xml").decode()
        assert z.read("word/styles.xml") == zipfile.ZipFile(folder / "a.docx").read("word/styles.xml")
    old = document(BODY).decode()
    expected = old.replace("Leand<", "ID1<").replace("ro Con<", "<").replace("tini &amp;", " &amp;")
    assert new.startswith(expected[: expected.index("<w:p><w:sdt>")])
    assert 'xmlns:z="urn:unused"' in new
    texts = whole(blocks_of(packages.read_packages(spark, str(out), "a-*.docx")))
    got = [t for _, t in sorted(texts.items())]
    # separators are nodes of their own: they stay, but those inside a name become empty
    assert [t.replace("\t", "") for t in got] == [
        "ID1 & C.", "ID1", "Leandro ", "ID1", "Contini", "ID1x", "Leandro", " Contini", "ID1",
        "fine", "ID1",
    ]
    assert "Mario" not in header and "Contini" not in header


def test_parts_by_relationship_and_equal_names(spark, lines, tmp_path):
    def relations(*rows):
        body = "".join(
            f'<Relationship Id="r{k}" Type="http://x/{kind}" Target="{target}"/>'
            for k, (kind, target) in enumerate(rows)
        )
        return f'<Relationships xmlns="http://y">{body}</Relationships>'

    def part(text):
        return f'<w:part xmlns:w="{W}"><w:p><w:r><w:t>{text}</w:t></w:r></w:p></w:part>'

    for folder in ("x", "y/z"):
        (tmp_path / "in" / folder).mkdir(parents=True)
        with zipfile.ZipFile(tmp_path / "in" / folder / "doc.docx", "w") as z:
            z.writestr("_rels/.rels", relations(("officeDocument", "/word/main.xml")))
            z.writestr(
                "word/_rels/main.xml.rels",
                relations(("footnotes", "notes/mine.xml"), ("header", "myheader.xml"), ("styles", "s.xml"), ("footer", "gone.xml")),
            )
            z.writestr("word/main.xml", part(f"Leandro Contini {folder}"))
            z.writestr("word/notes/mine.xml", part("note of Leandro Contini"))
            z.writestr("word/myheader.xml", part("Contini Leandro"))
            z.writestr("word/footer3.xml", part("Leandro Contini"))
            z.writestr("word/s.xml", part("Leandro Contini"))
    files = packages.read_packages(spark, str(tmp_path / "in"))
    new_files, _ = pieces.redact_packages(files, people=lists.parse_people(lines("Leandro;Contini")))
    out = tmp_path / "out"
    sink.write_packages(new_files, str(out))
    results = sorted(str(p.relative_to(out)) for p in out.rglob("*.docx"))
    assert results == ["x/doc-result.docx", "y/z/doc-result.docx"]
    for name in results:
        with zipfile.ZipFile(out / name) as z:
            told = {n: z.read(n).decode() for n in z.namelist()}
        assert name.rpartition("/")[0] in told["word/main.xml"]
        for n in ("word/main.xml", "word/notes/mine.xml", "word/myheader.xml", "word/footer3.xml"):
            assert "ID1" in told[n] and "Leandro" not in told[n], n
        assert "Leandro" in told["word/s.xml"]
    with pytest.raises(ValueError, match="two packages"):
        sink.result_table(new_files.unionAll(new_files))


def test_splice_keeps_every_other_byte():
    data = "<a xmlns:w='{0}'><w:t>è</w:t><!-- c --><w:t/><w:t>x&lt;y</w:t></a>".format(W).encode()
    assert sink.splice(data, {1: "E", 3: "<&>"}) == (
        "<a xmlns:w='{0}'><w:t>E</w:t><!-- c --><w:t/><w:t>&lt;&amp;&gt;</w:t></a>".format(W).encode()
    )


def test_reports_as_text(spark, tmp_path):
    counts = spark.createDataFrame([("Anna", 2), ("Mario", 9), ("Bea", 2)], "plain_name string, cnt bigint")
    report_sink.write_report(report_sink.frequency_lines(counts), str(tmp_path / "f"))
    got = "".join(p.read_text() for p in sorted((tmp_path / "f").glob("part-*")))
    assert got == "FREQUENCIES:\nKey: Mario\tValue: 9\nKey: Anna\tValue: 2\nKey: Bea\tValue: 2\n"
    told = spark.createDataFrame([("B", "y"), ("A", "x")], "name_key string, pseudonym string")
    report_sink.write_report(report_sink.association_lines(told), str(tmp_path / "a"))
    got = "".join(p.read_text() for p in sorted((tmp_path / "a").glob("part-*")))
    assert got == "ASSOCIATIONS:\nKey: A\tValue: x\nKey: B\tValue: y\n"


def test_failed_write_leaves_nothing(spark, tmp_path):
    names = [(f"/in/f{k % 3}/d{k}.docx", bytes([k])) for k in range(40)]
    files = spark.createDataFrame(names, "path string, content binary").repartition(4)
    broken = files.withColumn(
        "content", F.when(F.col("path") == "/in/f1/d7.docx", F.raise_error(F.lit("no"))).otherwise(F.col("content"))
    )
    out = tmp_path / "out"
    with pytest.raises(Exception, match="no"):
        sink.write_packages(broken.withColumn("content", F.col("content").cast("binary")), str(out))
    assert [p for p in out.rglob("*") if p.is_file()] == []
    sink.write_packages(files, out.as_uri())
    back = packages.read_packages(spark, str(out))
    assert back.count() == len(list(out.rglob("*.docx"))) == 40
    assert not [p for p in out.iterdir() if p.name.startswith(".")]
    assert {bytes(r.content) for r in back.collect()} == {c for _, c in names}


def test_local_folders_are_not_listed_on_the_driver(spark, tmp_path):
    names = ["a.docx", "x/b.docx", "x/y z/c.docx", "d.txt", ".e.docx", "_f.docx", "_g/h.docx", ".i/j.docx", "_k=1/l.docx"]
    for k, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(bytes([k]))
    by_spark = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").option(
        "recursiveFileLookup", "true"
    )
    want = {(r.path, bytes(r.content)) for r in by_spark.load(str(tmp_path)).collect()}
    for path in (str(tmp_path), tmp_path.as_uri(), f"file:{tmp_path}/"):
        files = packages.read_packages(spark, path)
        assert files._jdf.queryExecution().optimizedPlan().toString().count("binaryFile") == 0
        got = files.collect()
        assert {(r.path, bytes(r.content)) for r in got} == want and len(got) == len(want) == 4
        assert all(r.doc_id == r.path for r in got)
    assert packages.read_packages(spark, f"{tmp_path}/x*").count() == 2
    assert packages.read_packages(spark, str(tmp_path), "[a].docx").count() == 1


def test_commit_messages_hold_no_list_of_results(tmp_path):
    writer = sink.PackageWriter(str(tmp_path))
    rows = [{"result": f"p{k}/d\n{k}.docx", "content": bytes([k % 256])} for k in range(500)]
    said = [writer.write(iter(rows[:300])), writer.write(iter(rows[300:])), writer.write(iter([]))]
    assert all(len(repr(m)) < 100 for m in said)
    writer.commit([*said, None])
    assert all((tmp_path / r["result"]).read_bytes() == r["content"] for r in rows)
    assert len([p for p in tmp_path.rglob("*") if p.is_file()]) == 500


def test_renamed_parts_in_two_folders(spark, lines, tmp_path):
    rels = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    related = (
        "<Relationships xmlns='http://schemas.openxmlformats.org/package/2006/relationships'>"
        f"<Relationship Id='a' Type='{rels}/footnotes' Target='notes/own.xml'/></Relationships>"
    ).encode()
    parts = {
        "word/document.xml": document(f"<w:p>{run('plain')}</w:p>"),
        "word/_rels/document.xml.rels": related,
        "word/notes/own.xml": document(f"<w:p>{run('Mario Rossi')}</w:p>", "footnotes"),
    }
    for name in ("one/a.docx", "two/a.docx"):
        (tmp_path / "in" / name).parent.mkdir(parents=True)
        (tmp_path / "in" / name).write_bytes(package(parts))
    files = packages.read_packages(spark, str(tmp_path / "in"))
    redacted, _ = pieces.redact_packages(files, people=lists.parse_people(lines("Mario;Rossi")))
    sink.write_packages(redacted, str(tmp_path / "out"))
    back = whole(pieces.package_pieces(packages.read_packages(spark, str(tmp_path / "out"))))
    assert sorted(back.values()) == ["ID1", "ID1", "plain", "plain"]
    assert {d.rsplit("/", 2)[1] for d, _ in back} == {"one", "two"}


def test_packages_are_parsed_once(spark, folder):
    files = packages.read_packages(spark, str(folder))
    plan = pieces.package_pieces(files)._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan


def test_small_packages_share_arrow_batches(monkeypatch):
    import pyarrow as pa

    one = package({"word/document.xml": document(BODY), "word/header1.xml": document(BODY, "hdr")})
    given = pa.RecordBatch.from_pydict({"doc_id": [f"d{k}" for k in range(20)], "content": [one] * 20})
    whole_ = pa.Table.from_batches(packages._flatten(iter([given, given])))
    # 80 parts in one batch, and the same rows in a batch for each part
    assert len(list(packages._flatten(iter([given, given])))) == 1
    monkeypatch.setattr(packages, "BATCH_NODES", 1)
    parts = list(packages._flatten(iter([given, given])))
    assert len(parts) == 81 and pa.Table.from_batches(parts).equals(whole_)
    first = whole_.slice(0, 60).to_pylist()
    assert [r["pos"] for r in first] == list(range(60))
    run_text = next(r for r in first if r["tag"] == "t")
    assert [a["tag"] for a in run_text["ancestors"]] == ["document", "p", "r"]
    assert run_text["parent_id"] == run_text["ancestors"][-1]["node_id"]


def test_results_are_worked_out_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def slow(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    names = [(f"/in/d{k}.docx", bytes([k])) for k in range(8)]
    files = spark.createDataFrame(names, "path string, content binary")
    sink.write_packages(files.mapInPandas(slow, files.schema), str(tmp_path / "out"))
    assert seen.value == 8
    assert len(list((tmp_path / "out").rglob("*.docx"))) == 8
