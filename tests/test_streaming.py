import pytest

from inkveil.operators import people as persons
from inkveil.sources import lists
from inkveil.streaming.live import redact_stream


def test_stream_equals_batch(spark, lines, blocks, tmp_path):
    entries = persons.entries(lists.parse_people(lines("Mario;Rossi", "Anna;Neri")))
    texts = [f"{i}: Mario Rossi e Neri Anna" for i in range(40)]
    source = tmp_path / "in"
    blocks(*texts).repartition(4).write.parquet(str(source))
    stream = spark.readStream.schema("doc_id bigint, text string").option(
        "maxFilesPerTrigger", 1
    ).parquet(str(source))
    query = (
        redact_stream(stream, ["doc_id"], entries)
        .writeStream.format("memory").queryName("redacted")
        .option("checkpointLocation", str(tmp_path / "state"))
        .start()
    )
    query.processAllAvailable()
    query.stop()
    got = {r.doc_id: r.text for r in spark.table("redacted").collect()}
    assert got == {i: f"{i}: ID1 e ID2" for i in range(40)}
    with pytest.raises(ValueError, match="lettered"):
        redact_stream(stream, ["doc_id"], entries, scheme="lettered")
