from marginflow.functions.kernels import (KERNELS, block_kernel, block_kernel_sum,
                                          curvature_expr, dot, kernel_expr,
                                          sq_distance)
from marginflow.functions.smo import lower_bound, pair_step, upper_bound

__all__ = ["KERNELS", "block_kernel", "block_kernel_sum", "curvature_expr", "dot",
           "kernel_expr", "sq_distance", "lower_bound", "upper_bound",
           "pair_step"]
