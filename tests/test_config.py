from eventlake.config import StreamConfig, kafka_sink_options, kafka_source_options


def test_source_options_without_login():
    o = kafka_source_options(StreamConfig(bootstrap_servers="b:9092", topic="t", starting_offsets="earliest"))
    assert o == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "50000",
        "failOnDataLoss": "false",
    }


def test_source_options_with_login():
    o = kafka_source_options(StreamConfig(sasl_username="u", sasl_password="p", jaas_module="x.Scram"))
    assert o["kafka.security.protocol"] == "SASL_SSL"
    assert o["kafka.sasl.mechanism"] == "SCRAM-SHA-256"
    assert o["kafka.sasl.jaas.config"] == 'x.Scram required username="u" password="p";'


def test_sink_options():
    o = kafka_sink_options(StreamConfig(topic="t"))
    assert o["kafka.acks"] == "all" and o["kafka.enable.idempotence"] == "true"
    assert o["kafka.compression.type"] == "gzip" and o["kafka.linger.ms"] == "200" and o["kafka.retries"] == "5"
    assert "kafka.sasl.jaas.config" not in o


def test_paths():
    c = StreamConfig(checkpoint_base="s3://b/ck/", table_base="s3://b/tb")
    assert c.checkpoint_path("events_v1") == "s3://b/ck/events_v1"
    assert c.table_path("events_v1") == "s3://b/tb/events_v1"
