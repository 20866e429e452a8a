"""What the engine computes, as lazy DataFrames over given inputs."""
