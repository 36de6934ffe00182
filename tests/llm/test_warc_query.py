import json

from tracewell.llm import warc
from tracewell.llm.queries import QUERIES


def test_query_returns_whole_records(spark, sf_dir):
    rows = QUERIES["op3_warc_derivatives"](spark, sf_dir).limit(40).collect()
    assert {r["record_type"] for r in rows} == {"metadata", "conversion"}
    for r in rows:
        made = next(warc.parse(r["record"].encode()))
        assert made.get("WARC-Record-ID") == r["record_id"] and warc.digest_of(made.block) == r["block_digest"]
        if r["record_type"] == "metadata":
            assert ["WARC-Type", "response"] in json.loads(made.block)["source"]["warc-headers"]
