"""Sources and sinks: clip archives, manifests, CSV exports, raw fields, scores, embeddings, caches."""
