"""Feed descriptions, the generic feed job and the whole run."""
