import pytest

from spillway.options import CLIENT_ID, DEFAULT_GROUP_SUFFIX, TransferOptions
from spillway.sinks.file_log import kafka_sink_options
from spillway.sources.topic_log import kafka_source_options


def _o(**kw):
    base = dict(topic="orders", source="src:9092", destination="dst:9092",
                source_format="kafka", destination_format="kafka")
    base.update(kw)
    return TransferOptions(**base)


def test_reference_defaults_and_group_name():
    o = _o()
    assert o.group == f"orders_{DEFAULT_GROUP_SUFFIX}"
    assert (o.max_errors, o.max_retry, o.flush_interval_ms, o.consumer_concurrency) == (10, 5, 10000, 4)
    assert o.trigger_interval == "10000 milliseconds"
    assert o.read_limit is None  # the reference's buffer bounds memory, not rate
    assert _o(group_suffix="x").group == "orders_x"


def test_kafka_source_options():
    o = kafka_source_options(_o(read_limit=500, consumer_concurrency=8))
    assert o["subscribe"] == "orders" and o["startingOffsets"] == "latest"
    assert o["maxOffsetsPerTrigger"] == "500" and o["minPartitions"] == "8"
    assert kafka_source_options(_o(start_at="earliest"))["startingOffsets"] == "earliest"
    assert o["failOnDataLoss"] == "true"
    assert kafka_source_options(_o(fail_on_data_loss=False))["failOnDataLoss"] == "false"


def test_kafka_sink_options_are_the_delivery_options():
    o = kafka_sink_options(_o(max_retry=7))
    assert o["kafka.compression.type"] == "gzip"
    assert o["kafka.acks"] == "1"
    assert o["kafka.retries"] == "7"
    assert o["kafka.client.id"] == CLIENT_ID
    assert o["kafka.linger.ms"] == "10000"
    assert "kafka.batch.size" not in o  # counts bytes, not messages
    assert o["topic"] == "orders"


def test_validation():
    with pytest.raises(ValueError):
        _o(topic="")
    with pytest.raises(ValueError):
        _o(source_format="jdbc")
    with pytest.raises(ValueError):
        _o(read_limit=0)
    with pytest.raises(ValueError):
        _o(start_at="middle")


def test_repr_hides_extra_options():
    o = _o(extra_sink_options=(("kafka.sasl.jaas.config", "secret"),))
    assert "secret" not in repr(o)


def test_command_line_maps_to_options():
    from spillway.__main__ import parse
    o, trig = parse(["--topic", "t", "--source", "/a", "--destination", "/b", "--reset-offset",
                     "--max-errors", "3", "--flush-interval", "500", "--trigger", "available_now"])
    assert (o.topic, o.reset, o.max_errors, o.flush_interval_ms, trig) == ("t", True, 3, 500, "available_now")
    assert o.group == f"t_{DEFAULT_GROUP_SUFFIX}"


def test_run_concurrently_runs_all_and_raises_the_failure():
    from spillway.sinks.file_log import run_concurrently
    done = []
    run_concurrently([lambda: done.append(1), lambda: done.append(2), lambda: done.append(3)])
    assert sorted(done) == [1, 2, 3]

    def boom():
        raise RuntimeError("write failed")
    with pytest.raises(RuntimeError, match="write failed"):
        run_concurrently([lambda: done.append(4), boom])
    assert 4 in done


def test_state_needs_a_shared_folder_off_a_local_master():
    from types import SimpleNamespace

    from spillway.session import is_local, state_root
    at = lambda master: SimpleNamespace(sparkContext=SimpleNamespace(master=master))
    assert [is_local(at(m)) for m in ("local", "local[4]", "local-cluster[3,2,900]", "yarn")] == [True, True, False, False]
    none = SimpleNamespace(isDefined=lambda: False)
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda *_: None),
        sparkContext=SimpleNamespace(master="yarn", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none))))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        state_root(cluster)
