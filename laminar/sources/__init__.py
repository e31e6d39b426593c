"""Payload and table sources."""

from laminar.sources.payloads import (KeyAudit, answered, bag_union, city_ids, envelope_ids, flatten_infrastructure,
                                      id_lookup, literal_grid, literal_states, parameter_grid, parse_objects,
                                      read_objects, read_payloads, required, shard_filter)

__all__ = ["KeyAudit", "answered", "bag_union", "city_ids", "envelope_ids", "flatten_infrastructure", "id_lookup",
           "literal_grid", "literal_states", "parameter_grid", "parse_objects", "read_objects", "read_payloads",
           "required", "shard_filter"]
