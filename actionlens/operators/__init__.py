"""DataFrame -> DataFrame operators of the behaviour-log analysis."""
