"""Kafka source options (S1-S4), checked with a recording reader: the Kafka
connector is not on this classpath, so the reader itself is not exercised."""

from tidemark.sources.kafka import kafka_stream


class _Recorder:
    def __init__(self):
        self.fmt, self.options, self.loaded = None, {}, False

    def format(self, f):
        self.fmt = f
        return self

    def option(self, k, v):
        self.options[k] = v
        return self

    def load(self):
        self.loaded = True
        return "stream"


class _Session:
    def __init__(self):
        self.readStream = _Recorder()


def test_subscribe_start_position_loss_tolerance_rate_limit():
    s = _Session()
    assert kafka_stream(s, "user_activity_events", "kafka:9092", max_offsets_per_trigger=6000) == "stream"
    r = s.readStream
    assert r.fmt == "kafka" and r.loaded
    assert r.options == {"kafka.bootstrap.servers": "kafka:9092", "subscribe": "user_activity_events",
                         "startingOffsets": "earliest", "failOnDataLoss": "false",
                         "maxOffsetsPerTrigger": 6000}


def test_no_rate_limit_by_default_and_extra_options():
    s = _Session()
    kafka_stream(s, "order_events", "b:1", starting_offsets="latest", fail_on_data_loss=True,
                 **{"kafka.security.protocol": "SSL"})
    o = s.readStream.options
    assert "maxOffsetsPerTrigger" not in o
    assert o["startingOffsets"] == "latest" and o["failOnDataLoss"] == "true"
    assert o["kafka.security.protocol"] == "SSL"
