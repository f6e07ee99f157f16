"""Readers and writers: message sources, IP ranges, the star tables, JDBC."""
