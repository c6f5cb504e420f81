"""DataFrame -> DataFrame operators. None of them writes, except the record_* appends."""
