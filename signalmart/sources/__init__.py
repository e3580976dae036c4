from signalmart.sources.raw import (  # noqa: F401
    land_raw, local_table, read_partitioned, read_raw, read_seed, read_table,
    reject_counts, typed_projection,
)
from signalmart.sources.payloads import (  # noqa: F401
    arrival_rows, iso_parts, read_json_lines, weather_rows,
)
