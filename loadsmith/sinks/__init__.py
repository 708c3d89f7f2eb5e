from loadsmith.sinks.publish import (
    append_load,
    land_documents,
    publish_dimension,
    read_dimension,
    truncate_reload,
    write_observed,
)

__all__ = ["append_load", "land_documents", "publish_dimension", "read_dimension",
           "truncate_reload", "write_observed"]
