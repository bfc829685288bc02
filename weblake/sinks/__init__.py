"""Writers: gold tables (define, merge), text lines, JDBC, report views."""
