"""Import every query module so the registry is complete."""

from . import q_bins, q_build, q_conf, q_joins, q_manifest, q_shards, q_stream, q_text, q_vocab  # noqa: F401
