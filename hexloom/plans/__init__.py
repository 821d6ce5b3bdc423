"""Theme specifications, whole builds and the command line."""
