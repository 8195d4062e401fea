"""The models: landing -> bronze -> silver star -> gold marts, and their checks."""
