"""Shared-entity graph: store, views, traversal, components, queues, replay."""
