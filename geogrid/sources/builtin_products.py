"""Builtin tables of single readers and instruments: default products, day and night criteria, element labels and
composite recipes, as rows."""

from __future__ import annotations

#: Fixed values. reader | products loaded where none are asked for.
DEFAULT_PRODUCTS = """
abi_l1b | C01 C02 C03 C04 C05 C06 C07 C08 C09 C10 C11 C12 C13 C14 C15 C16 true_color natural_color
abi_l2_nc | AOD HT LST TEMP Fog_Depth IFR_Fog_Prob LIFR_Fog_Prob MVFR_Fog_Prob PRES Phase
acspo | sst
agri_fy4a_l1 | C01 C02 C03 C04 C05 C06 C07 C08 C09 C10 C11 C12 C13 C14 true_color natural_color
agri_fy4b_l1 | C01 C02 C03 C04 C05 C06 C07 C08 C09 C10 C11 C12 C13 C14 C15 true_color natural_color
ahi_hrit | B03 B04 B05 B06 B07 B08 B09 B10 B11 B12 B13 B14 B15 B16 natural_color
ahi_hsd | B01 B02 B03 B04 B05 B06 B07 B08 B09 B10 B11 B12 B13 B14 B15 B16 true_color natural_color
ami_l1b | VI004 VI005 VI006 VI008 NR013 NR016 SW038 WV063 WV069 WV073 IR087 IR096 IR105 IR112 IR123 IR133 true_color natural_color
amsr2_l1b | btemp_36.5v btemp_36.5h btemp_89.0av btemp_89.0ah btemp_89.0bv btemp_89.0bh
amsr2_l2_gaasp | Rain_Rate CLW SST TPW WSPD Snow_Cover SWE Snow_Depth Soil_Moisture
avhrr_l1b_aapp | band1_vis band2_vis band3a_vis band3b_bt band4_bt band5_bt
aws1_mwr_l1b_nc | bt01 bt02 bt03 bt04 bt05 bt06 bt07 bt08 bt09 bt10 bt11 bt12 bt13 bt14 bt15 bt16 bt17 bt18 bt19
clavrx | cloud_type cld_temp_acha cld_height_acha cloud_phase cld_opd_dcomp cld_opd_nlcomp cld_reff_dcomp cld_reff_nlcomp cld_emiss_acha refl_lunar_dnb_nom rain_rate
fci_l1c_nc | vis_04 vis_05 vis_06 vis_08 vis_09 nir_13 nir_16 nir_22 ir_38 wv_63 wv_73 ir_87 ir_97 ir_105 ir_123 ir_133 true_color natural_color
glm_l2 | flash_extent_density group_extent_density flash_centroid_density group_centroid_density average_flash_area minimum_flash_area average_group_area total_energy
mersi2_l1b | 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22 23 24 25 true_color false_color
mersi_ll_l1b | 2 3 4 5 6 7 adaptive_dnb
mirs | rain_rate btemp_88v btemp_89v1
modis_l1b | vis01 vis02 vis03 vis04 vis05 vis06 vis07 vis26 bt20 bt21 bt22 bt23 bt24 bt25 bt27 bt28 bt29 bt30 bt31 bt32 bt33 bt34 bt35 bt36 true_color false_color fog
modis_l2 | cloud_mask land_sea_mask snow_ice_mask sst lst ndvi ist inversion_strength inversion_depth ice_concentration ctt tpw
nucaps | Topography Surface_Pressure Skin_Temperature
omps_edr | Reflectivity331 AerosolIndex ColumnAmountO3
viirs_edr | surf_refl_i01 surf_refl_i02 surf_refl_i03 surf_refl_m01 surf_refl_m02 surf_refl_m03 surf_refl_m04 surf_refl_m05 surf_refl_m07 surf_refl_m08 surf_refl_m10 surf_refl_m11 true_color_surf false_color_surf NDVI EVI CldTopTemp CldTopHght AOD550 VLST CloudPhase CldBaseHght Total_Cloud_Fraction CloudLayer IceAge IceThickness IceConc IceSrfTemp
viirs_edr_active_fires | T4 T13 confidence_cat confidence_pct power
viirs_edr_flood | WaterDetection
viirs_l1b | i01 i02 i03 i04 i05 m01 m02 m03 m04 m05 m06 m07 m08 m09 m10 m11 m12 m13 m14 m15 m16 true_color false_color adaptive_dnb dynamic_dnb hncc_dnb ifog
viirs_sdr | i01 i02 i03 i04 i05 m01 m02 m03 m04 m05 m06 m07 m08 m09 m10 m11 m12 m13 m14 m15 m16 adaptive_dnb dynamic_dnb hncc_dnb true_color false_color ifog
virr_l1b | 1 2 3 4 5 6 7 8 9 10 solar_zenith_angle solar_azimuth_angle sensor_zenith_angle sensor_azimuth_angle true_color
"""

#: Fixed values. reader | day or night | key | values: products that need daylight, or darkness.
DAY_NIGHT = """
avhrr_l1b_aapp | day | standard_name | toa_bidirectional_reflectance corrected_reflectance
clavrx | day | name | cld_opd_dcomp cld_reff_dcomp
clavrx | night | name | cld_opd_nlcomp cld_reff_nlcomp refl_lunar_dnb_nom
mersi2_l1b | day | standard_name | toa_bidirectional_reflectance true_color false_color natural_color
mersi_ll_l1b | day | standard_name | toa_bidirectional_reflectance true_color false_color natural_color
modis_l1b | day | standard_name | toa_bidirectional_reflectance corrected_reflectance true_color false_color natural_color
modis_l1b | night | standard_name | temperature_difference
viirs_edr | day | standard_name | surface_bidirectional_reflectance true_color false_color natural_color
viirs_l1b | day | standard_name | toa_bidirectional_reflectance true_color false_color natural_color corrected_reflectance
viirs_l1b | night | standard_name | temperature_difference
viirs_sdr | day | standard_name | toa_bidirectional_reflectance true_color false_color natural_color corrected_reflectance
viirs_sdr | night | standard_name | temperature_difference
virr_l1b | day | standard_name | toa_bidirectional_reflectance true_color corrected_reflectance
"""

#: Fixed values. name | reader | sensor | physical element (no units).
ELEMENTS = """
dynamic_dnb_saturation | | | Dynamic DNB
viirs_crefl01 | | | 0.67 um CR
viirs_crefl02 | | | 0.87 um CR
viirs_crefl03 | | | 0.49 um CR
viirs_crefl04 | | | 0.56 um CR
viirs_crefl05 | | | 1.24 um CR
viirs_crefl06 | | | 1.61 um CR
viirs_crefl07 | | | 2.25 um CR
viirs_crefl08 | | | 0.64 um CR
viirs_crefl09 | | | 0.87 um CR
viirs_crefl10 | | | 1.61 um CR
1 | | modis | 0.65 um
2 | | modis | 0.86 um
3 | | modis | 0.47 um
4 | | modis | 0.56 um
5 | | modis | 1.24 um
6 | | modis | 1.64 um
7 | | modis | 2.13 um
26 | | modis | 1.38 um
20 | | modis | 3.75 um
21 | | modis | Fire
22 | | modis | 3.96 um
23 | | modis | 4.05 um
24 | | modis | 4.47 um
25 | | modis | 4.52 um
27 | | modis | 6.7 um
28 | | modis | 7.3 um
29 | | modis | 8.6 um
30 | | modis | 9.7 um
31 | | modis | 11.0 um
32 | | modis | 12.0 um
33 | | modis | 13.3 um
34 | | modis | 13.6 um
35 | | modis | 13.9 um
36 | | modis | 14.2 um
sea_surface_temperature | | modis | SST
lst | | modis | LST
slst | | modis | LSTSUM
cloud_top_temperature | | modis | CTT
ndvi | | modis | NDVI
water_vapor | | modis | TPW
ice_concentration | | modis | Ice Concentration
ice_surface_temperatue | | modis | Ice Surface Temperature
modis_crefl01_250m | | | 0.65 um CR
modis_crefl01_500m | | | 0.65 um CR
modis_crefl01_1000m | | | 0.65 um CR
modis_crefl02_250m | | | 0.86 um CR
modis_crefl02_500m | | | 0.86 um CR
modis_crefl02_1000m | | | 0.86 um CR
modis_crefl03_250m | | | 0.47 um CR
modis_crefl03_500m | | | 0.47 um CR
modis_crefl03_1000m | | | 0.47 um CR
modis_crefl04_250m | | | 0.56 um CR
modis_crefl04_500m | | | 0.56 um CR
modis_crefl04_1000m | | | 0.56 um CR
modis_crefl05_500m | | | 1.24 um CR
modis_crefl05_1000m | | | 1.24 um CR
modis_crefl06_500m | | | 1.64 um CR
modis_crefl06_1000m | | | 1.64 um CR
modis_crefl07_500m | | | 2.13 um CR
modis_crefl07_1000m | | | 2.13 um CR
btemp_23v | | | MIRS 23 GHZ V
btemp_31v | | | MIRS 31 GHZ V
btemp_50h | | | MIRS 50 GHZ H
btemp_51h | | | MIRS 51 GHZ H
btemp_52h | | | MIRS 52 GHZ H
btemp_53h | | | MIRS 53 GHZ H
btemp_54h1 | | | MIRS 54 GHZ H-1
btemp_54h2 | | | MIRS 54 GHZ H-2
btemp_55h | | | MIRS 55 GHZ H
btemp_57h1 | | | MIRS 57 GHZ H-1
btemp_57h2 | | | MIRS 57 GHZ H-2
btemp_57h3 | | | MIRS 57 GHZ H-3
btemp_57h4 | | | MIRS 57 GHZ H-4
btemp_57h5 | | | MIRS 57 GHZ H-5
btemp_57h6 | | | MIRS 57 GHZ H-6
btemp_88v | | | MIRS 88 GHZ V
btemp_165h | | | MIRS 165 GHZ H
btemp_183h1 | | | MIRS 183 GHZ H-1
btemp_183h2 | | | MIRS 183 GHZ H-2
btemp_183h3 | | | MIRS 183 GHZ H-3
btemp_183h4 | | | MIRS 183 GHZ H-4
btemp_183h5 | | | MIRS 183 GHZ H-5
btemp_50v | | | MIRS 50 GHZ V
btemp_52v | | | MIRS 52 GHZ V
btemp_54h | | | MIRS 54 GHZ H
btemp_54v | | | MIRS 54 GHZ V
btemp_89v1 | | | MIRS 89 GHZ V-1
btemp_89v2 | | | MIRS 89 GHZ V-2
btemp_157v | | | MIRS 157 GHZ V
btemp_190v | | | MIRS 190 GHZ V
RR | mirs | | MIRS Rain Rate
Snow | mirs | | MIRS Snow Cover
SIce | mirs | | MIRS Sea Ice
SWE | mirs | | MIRS SWE
CLW | mirs | | MIRS CLW
TPW | mirs | | MIRS TPW
TSkin | mirs | | MIRS Skin Temperature
SnowGS | mirs | | MIRS Snow Grain Size
"""

#: Fixed values. sensor | composite | how | inputs, each with its modifiers after + | optional inputs | argument: the
#: sharpening band, or the band taken from a colour.
COMPOSITES = """
viirs | unsharp_true_color | rgb | M05+sunz_corrected+rayleigh_corrected M04+sunz_corrected+rayleigh_corrected M03+sunz_corrected+rayleigh_corrected | |
viirs | true_color | ratio_sharpened | M05+sunz_corrected+rayleigh_corrected M04+sunz_corrected+rayleigh_corrected M03+sunz_corrected+rayleigh_corrected | I01+sunz_corrected+rayleigh_corrected | r
viirs | _preenhanced_true_color | pre_enhanced | true_color | |
viirs | _preenhanced_false_color | pre_enhanced | false_color | |
viirs | viirs_crefl01 | sub_band | _preenhanced_true_color | | R
viirs | viirs_crefl02 | sub_band | _preenhanced_false_color | | G
viirs | viirs_crefl03 | sub_band | _preenhanced_true_color | | B
viirs | viirs_crefl04 | sub_band | _preenhanced_true_color | | G
viirs | viirs_crefl07 | sub_band | _preenhanced_false_color | | R
viirs | viirs_crefl08 | sub_band | _preenhanced_true_color | | R
viirs | viirs_crefl09 | sub_band | _preenhanced_false_color | | G
viirs | _crefl01 | single | M05+sunz_corrected+rayleigh_corrected | |
viirs | _crefl02 | single | M07+sunz_corrected+rayleigh_corrected | |
viirs | _crefl03 | single | M03+sunz_corrected+rayleigh_corrected | |
viirs | _crefl04 | single | M04+sunz_corrected+rayleigh_corrected | |
viirs | _crefl05 | single | M08+sunz_corrected+rayleigh_corrected | |
viirs | _crefl06 | single | M10+sunz_corrected+rayleigh_corrected | |
viirs | _crefl07 | single | M11+sunz_corrected+rayleigh_corrected | |
viirs | _crefl08 | single | I01+sunz_corrected+rayleigh_corrected | |
viirs | _crefl09 | single | I02+sunz_corrected+rayleigh_corrected | |
viirs | _crefl10 | single | I03+sunz_corrected+rayleigh_corrected | |
viirs | false_color | ratio_sharpened | M11+sunz_corrected+rayleigh_corrected M07+sunz_corrected+rayleigh_corrected M05+sunz_corrected+rayleigh_corrected | I02+sunz_corrected+rayleigh_corrected | g
viirs | natural_color | ratio_sharpened | M10+sunz_corrected+rayleigh_corrected M07+sunz_corrected+rayleigh_corrected M05+sunz_corrected+rayleigh_corrected | I01+sunz_corrected+rayleigh_corrected | g
viirs | true_color_raw | rgb | M05+sunz_corrected M04+sunz_corrected M03+sunz_corrected | |
viirs | night_overview | rgb | DNB DNB M15 | |
viirs | ifog | difference | I05 I04 | |
viirs | dynamic_dnb | dynamic_dnb | DNB dnb_solar_zenith_angle dnb_lunar_zenith_angle dnb_moon_illumination_fraction | |
viirs | dynamic_dnb_saturation | dynamic_dnb | DNB dnb_solar_zenith_angle dnb_lunar_zenith_angle dnb_moon_illumination_fraction | | saturation
viirs | nbr | normalized_difference | M11 I02 | |
modis | true_color | ratio_sharpened | 1+sunz_corrected+rayleigh_corrected 4+sunz_corrected+rayleigh_corrected 3+sunz_corrected+rayleigh_corrected | 1_250m+sunz_corrected+rayleigh_corrected | r
modis | false_color | ratio_sharpened | 7+sunz_corrected+rayleigh_corrected 2+sunz_corrected+rayleigh_corrected 1+sunz_corrected+rayleigh_corrected | 2_250m+sunz_corrected+rayleigh_corrected | g
modis | fog | difference | 31 20 | |
modis | _preenhanced_true_color | pre_enhanced | true_color | |
modis | _preenhanced_false_color | pre_enhanced | false_color | |
modis | modis_crefl01_1000m | sub_band | _preenhanced_false_color | | B
modis | modis_crefl01_500m | sub_band | _preenhanced_false_color | | B
modis | modis_crefl01_250m | sub_band | _preenhanced_true_color | | R
modis | modis_crefl02_1000m | sub_band | _preenhanced_false_color | | G
modis | modis_crefl02_500m | sub_band | _preenhanced_false_color | | G
modis | modis_crefl02_250m | sub_band | _preenhanced_false_color | | G
modis | modis_crefl03_1000m | sub_band | _preenhanced_true_color | | B
modis | modis_crefl03_500m | sub_band | _preenhanced_true_color | | B
modis | modis_crefl03_250m | sub_band | _preenhanced_true_color | | B
modis | modis_crefl04_1000m | sub_band | _preenhanced_true_color | | G
modis | modis_crefl04_500m | sub_band | _preenhanced_true_color | | G
modis | modis_crefl04_250m | sub_band | _preenhanced_true_color | | G
modis | modis_crefl07_500m | sub_band | _preenhanced_false_color | | R
modis | modis_crefl07_250m | sub_band | _preenhanced_false_color | | R
modis | _crefl01 | sum | 1+sunz_corrected+rayleigh_corrected | |
modis | _crefl02 | sum | 2+sunz_corrected+rayleigh_corrected | |
modis | _crefl03 | sum | 3+sunz_corrected+rayleigh_corrected | |
modis | _crefl04 | sum | 4+sunz_corrected+rayleigh_corrected | |
modis | _crefl05 | sum | 5+sunz_corrected+rayleigh_corrected | |
modis | _crefl06 | sum | 6+sunz_corrected+rayleigh_corrected | |
modis | _crefl07 | sum | 7+sunz_corrected+rayleigh_corrected | |
abi | true_color_night | day_night_mix | true_color C14 solar_zenith_angle | |
ahi | true_color_night | day_night_mix | true_color B14 solar_zenith_angle | |
ahi | B01_rc | sum | B01+sunz_corrected+rayleigh_corrected | |
mersi-2 | false_color | ratio_sharpened | 7+sunz_corrected 15+sunz_corrected 3+sunz_corrected | 4+sunz_corrected | g
"""


def _rows(text: str) -> list[list[str]]:
    return [[x.strip() for x in line.split("|")] for line in text.strip().splitlines()]


def default_product_rows() -> list[tuple[str, str, int]]:
    """(reader, product, pos)."""
    return [(reader, p, k) for reader, names in _rows(DEFAULT_PRODUCTS) for k, p in enumerate(names.split())]


def day_night_rows() -> list[tuple[str, str, str, str]]:
    """(reader, light, key, value)."""
    return [(reader, light, key, v) for reader, light, key, values in _rows(DAY_NIGHT) for v in values.split()]


def element_rows() -> list[tuple[str, str | None, str | None, str, str | None]]:
    """(name, reader, sensor, element, units)."""
    return [(name, reader or None, sensor or None, element, None) for name, reader, sensor, element in _rows(ELEMENTS)]


def composite_rows(sensor: str) -> list[tuple[str, str, tuple[str, ...], tuple[str, ...], str]]:
    """(name, how, inputs, optional inputs, argument) of a sensor's composites."""
    return [(name, how, tuple(inputs.split()), tuple(optional.split()), argument) for own, name, how, inputs, optional, argument in _rows(COMPOSITES) if own == sensor]
