from strata.streaming.landing import (  # noqa: F401
    Landing, arrivals, nonempty_by_dataset, route_by_path, routed_files, start_landing_stream, stream_landing,
)
