"""DataFrame operators: staging, marts, quality, BI, profiling, distances, operations."""
