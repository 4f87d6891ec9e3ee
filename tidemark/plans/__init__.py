"""Composed plans: control plane, table loads and the registered operator checks."""
