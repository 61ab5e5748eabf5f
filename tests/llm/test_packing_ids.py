"""Token ids do not pass through the packing search."""

import zlib

from waferlens.llm import packing


def test_ids_are_joined_to_the_search(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(40)
    docs = docs.unionByName(docs.limit(5))
    found = packing.pack_documents(docs, capacity=256, with_ids=True)
    search = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "FlatMapGroupsInPandas" in x]
    assert search and not any(" ids#" in x for x in search)
    rows = found.collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    plain = packing.pack_documents(docs, capacity=256).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32, r.length) for r in rows) == sorted((r.doc_id, r.piece, r.ids_crc32, r.length) for r in plain)
