"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference, duck_rows, spark_rows
from tests.conftest import SMALL

QUERIES, SQL = entry.queries(), entry.oracle_sql()

# Operators of the survey's inventory; reg_compat is a stub that answers nothing.
OPERATORS = """
src_envelope src_offsets src_multi src_pattern src_start src_reset src_seek src_group src_required_groups src_instances
src_poll src_ts sink_append sink_split sink_dynamic sink_bridge sink_topic_header sink_multi_txn sink_receipts sink_confirm
sink_delay sink_key map_values map_rekey filter_rows flat_map_tokens drop_tombstones pass_tombstones headers_enrich
headers_map observe_rows post_process ct_resolve decode_json decode_bytes decode_text decode_auto encode_auto native_coding
decode_embedded encode_embedded collect_serde part_assign part_hash part_selector part_override part_resize part_stream
part_multi_out part_routing_key route_event_type route_function route_reply branch_first multi_output merge_streams
route_exchange route_alternate join_stream_table_left join_stream_table_inner join_global join_interval join_asof agg_count
agg_reduce agg_collect win_tumbling_count win_tumbling_rekey win_concat win_gapfill win_buffer win_store late_drop tbl_latest
tbl_changelog tbl_compact tbl_materialize state_process state_get state_locate err_policy dlq_write dlq_name dlq_partition
dlq_batch dlq_mode recover_record retry_attempts retry_classify dlq_reprocess dlq_backoff dlq_truncate dlq_republish
err_handler queue_ttl queue_max_length queue_priority delivery_limit reg_register reg_validate reg_find reg_delete
reg_subject reg_stamp reg_reference reg_resolve reg_union batch_assemble batch_buffer batch_explode batch_build batch_nulls
batch_nested lag_group fn_apply fn_compose fn_curry fn_many fn_tuple
""".split()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_operator_is_registered():
    assert not set(OPERATORS) - set(QUERIES)
    assert not set(SQL) - set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = spark_rows(QUERIES[name](spark, SMALL))
    assert got[1], "no rows"
    if name in SQL:
        assert difference(got, duck_rows(duck, SQL[name])) is None


def test_entry(spark):
    rows = {r["key"]: r for r in entry.entry(spark).collect()}
    assert "UNKNOWN" in rows and sum(r["clicks"] for r in rows.values()) == 210
