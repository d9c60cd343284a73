"""tumbleweed: a config-driven feature engine on Spark.

Feature specs are rows of data.  Behaviour events are parsed, fanned out per
entity dimension, routed to specs, folded into fixed-length pane partials and
rolled up over look-back windows -- all with DataFrame operators, in batch and
in Structured Streaming.
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
