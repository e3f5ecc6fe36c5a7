"""Readers and sinks, and the derived test views over /root/testdata."""
