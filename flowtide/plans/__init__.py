from flowtide.plans.detection import block_anomalies, block_exceedances
from flowtide.plans.exploration import explore
from flowtide.plans.training import fit_detector, load_model, save_model

__all__ = [
    "block_anomalies", "block_exceedances", "explore", "fit_detector", "load_model", "save_model",
]
