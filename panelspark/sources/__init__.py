from panelspark.sources.readers import (  # noqa: F401
    literal_table,
    read_delimited,
    read_table,
    table_reader,
)
from panelspark.sources import schemas  # noqa: F401
