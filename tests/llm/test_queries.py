"""The registered queries: names, result schemas and whole tables; SQL where there is some."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from arlark.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables are not here")

SCHEMAS = {
    "op1_minhash": "doc_id:bigint,n_shingles:bigint,component_id:bigint,kept:boolean",
    "op2_mixing": "doc_id:bigint,size:bigint,source_size:bigint,target:double,taken:bigint",
    "op3_quality_rules": "doc_id:bigint,n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
                         "n_repeat_words:bigint,base_failed:boolean,kept:boolean",
    "op4_embeddings": "vec_id:bigint,n_links:bigint,component_id:bigint,kept:boolean",
    "op5_token_counts": "doc_id:bigint,n_bytes:bigint,n_tokens:bigint,over_limit:boolean",
    "op6_warc": "page_id:bigint,payload_bytes:bigint,payload_digest:string,record_type:string,refers_to:bigint",
    "op7_sharding": "doc_id:bigint,size:bigint,text_crc32:bigint,law:string,shard:int,slot:bigint,grown_shard:int",
    "op8_repeats": "doc_id:bigint,n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string",
    "op9_bpe_codec": "doc_id:bigint,n_tokens:bigint,ids_sha256:string,decoded_sha256:string",
    "op10_token_files": "doc_id:bigint,start:bigint,n_tokens:bigint,ids_crc32:bigint",
    "op11_collocations": "lang:string,rank:bigint,phrase:string,a:bigint,l:bigint,r:bigint,n:bigint,score:bigint",
    "op12_whitening": "vec_id:bigint,component:int,n:bigint,deviation:bigint,whitened:double,explained:double,identity_error:double",
    "op13_line_dedup": "doc_id:bigint,n_lines:bigint,n_dropped:bigint,kept_sha256:string",
}
TABLES = {"op4_embeddings": "embeddings", "op6_warc": "pages", "op12_whitening": "embeddings"}
#: Rows of the result for each row of the table; op11 has rows of its own.
ROWS_EACH = {"op12_whitening": 16, "op11_collocations": 0}


def test_every_query_is_registered():
    assert set(QUERIES) == set(SCHEMAS) and {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(SCHEMAS))
def test_schema_and_rows(spark, name):
    result = QUERIES[name](spark, SF)
    assert ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in result.schema) == SCHEMAS[name]
    table = TABLES.get(name, "documents")
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    key, each = result.columns[0], ROWS_EACH.get(name, 1)
    got = sorted(r[0] for r in result.select(key).collect())
    assert got == sorted(r[0] for r in rows.select(key).collect() for _ in range(each)) if each else got


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql_gives_the_same_rows(spark, name):
    sys.path.insert(0, os.path.join(os.path.dirname(entry.__file__), "scripts"))
    from check_oracle import compare

    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    same, message = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert same, message
