"""The models: cleaned entities, marts, checks, learning and scoring."""
