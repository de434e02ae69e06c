"""Builtin decision rules and naming tables as rows."""

from __future__ import annotations

#: Fixed values. rule | match keys | resampler | arguments; ``default_target`` is an argument too.
RESAMPLING = """
default_swath | area_type=swath | nearest |
default_area | area_type=area | | default_target=MAX
default_clavrx_all_products | reader=clavrx area_type=swath | ewa | weight_delta_max=40.0 weight_distance_max=1.0
default_clavrx_cloud_phase | name=cloud_phase reader=clavrx area_type=swath | ewa | weight_delta_max=40.0 weight_distance_max=1.0 maximum_weight_mode=True
default_clavrx_cloud_type | name=cloud_type reader=clavrx area_type=swath | ewa | weight_delta_max=40.0 weight_distance_max=1.0 maximum_weight_mode=True
avhrr_clavrx_all_products | reader=clavrx area_type=swath sensor=avhrr | ewa | weight_delta_max=40.0 weight_distance_max=1.0 rows_per_scan=0
avhrr_clavrx_cloud_phase | name=cloud_phase reader=clavrx area_type=swath sensor=avhrr | ewa | weight_delta_max=40.0 weight_distance_max=1.0 maximum_weight_mode=True rows_per_scan=0
avhrr_clavrx_cloud_type | name=cloud_type reader=clavrx area_type=swath sensor=avhrr | ewa | weight_delta_max=40.0 weight_distance_max=1.0 maximum_weight_mode=True rows_per_scan=0
default_amsr2 | area_type=swath sensor=amsr2 | nearest | radius_of_influence=7200
default_viirs_sdr | area_type=swath sensor=viirs reader=viirs_sdr | ewa | weight_delta_max=40.0 weight_distance_max=2.0
default_viirs_l1b | area_type=swath sensor=viirs reader=viirs_l1b | ewa | weight_delta_max=40.0 weight_distance_max=2.0
default_nucaps | area_type=swath reader=nucaps | nearest | radius_of_influence=40000
default_modis | area_type=swath sensor=modis | ewa | weight_delta_max=10.0 weight_distance_max=1.0
default_seadas_l2_viirs | area_type=swath sensor=viirs reader=seadas_l2 | ewa | weight_delta_max=40.0 weight_distance_max=2.0
default_seadas_l2_modis | area_type=swath sensor=modis reader=seadas_l2 | ewa | weight_delta_max=10.0 weight_distance_max=2.0
default_avhrr | area_type=swath sensor=avhrr | ewa | weight_delta_max=10.0 weight_distance_max=1.0 rows_per_scan=0
default_mirs_amsu | area_type=swath sensor=amsu reader=mirs | ewa | weight_delta_max=100.0 weight_distance_max=1.0 rows_per_scan=0
default_mirs_amsu-mhs | area_type=swath sensor=amsu-mhs reader=mirs | ewa | weight_delta_max=100.0 weight_distance_max=1.0 rows_per_scan=0
default_mirs_atms | area_type=swath sensor=atms reader=mirs | ewa | weight_delta_max=100.0 weight_distance_max=1.0 rows_per_scan=0
default_avhrr_band1_vis | area_type=swath name=band1_vis | ewa | weight_delta_max=10.0 weight_distance_max=1.0
default_avhrr_band2_vis | area_type=swath name=band2_vis | ewa | weight_delta_max=10.0 weight_distance_max=1.0
default_avhrr_band3a_vis | area_type=swath name=band3a_vis | ewa | weight_delta_max=10.0 weight_distance_max=1.0
default_avhrr_band3b_bt | area_type=swath name=band3b_bt | ewa | weight_delta_max=10.0 weight_distance_max=1.0
default_avhrr_band4_bt | area_type=swath name=band4_bt | ewa | weight_delta_max=10.0 weight_distance_max=1.0
default_avhrr_band5_bt | area_type=swath name=band5_bt | ewa | weight_delta_max=10.0 weight_distance_max=1.0
default_viirs_fire_T4 | area_type=swath sensor=viirs name=T4 | nearest | grid_coverage=0 radius_of_influence=2000
default_viirs_fire_T13 | area_type=swath sensor=viirs name=T13 | nearest | grid_coverage=0 radius_of_influence=2000
default_viirs_fire_confidence_cat | area_type=swath sensor=viirs name=confidence_cat | nearest | grid_coverage=0 radius_of_influence=2000
default_viirs_fire_confidence_pct | area_type=swath sensor=viirs name=confidence_pct | nearest | grid_coverage=0 radius_of_influence=2000
default_viirs_fire_power | area_type=swath sensor=viirs name=power | nearest | grid_coverage=0 radius_of_influence=2000
default_viirs_cloud_phase | name=CloudPhase reader=viirs_edr area_type=swath | ewa | weight_delta_max=40.0 weight_distance_max=2.0 maximum_weight_mode=True
default_viirs_cloud_layer | name=CloudLayer reader=viirs_edr area_type=swath | ewa | weight_delta_max=40.0 weight_distance_max=2.0 maximum_weight_mode=True
viirs_edr | area_type=swath sensor=viirs reader=viirs_edr | ewa | weight_delta_max=40.0 weight_distance_max=2.0
viirs_edr_iceage | name=IceAge area_type=swath sensor=viirs reader=viirs_edr | ewa | weight_delta_max=40.0 weight_distance_max=2.0 maximum_weight_mode=True
default_acspo_sst_viirs | area_type=swath name=sst sensor=viirs | ewa | weight_delta_max=40.0 weight_distance_max=1.0
default_acspo_sst_modis | area_type=swath name=sst sensor=modis | ewa | weight_delta_max=40.0 weight_distance_max=1.0
default_acspo_sst_avhrr | area_type=swath name=sst sensor=avhrr | ewa | weight_delta_max=40.0 weight_distance_max=1.0
default_mersi2_l1b | area_type=swath reader=mersi2_l1b | ewa | weight_delta_max=40.0 weight_distance_max=1.0
default_mersill_l1b | area_type=swath reader=mersi_ll_l1b | ewa | weight_delta_max=40.0 weight_distance_max=1.0
default_aws_mwr | area_type=swath sensor=mwr | nearest |
"""

#: Fixed values. rule | match keys | operations by their names in ``functions.enhance.METHODS``, in order; colorize names a
#: colour table and limits, auto stretches between the data's own limits.
ENHANCEMENTS = """
brightness_temperature_default | standard_name=toa_brightness_temperature | btemp_threshold 163.0 330.0 242.0
brightness_temperature_default_celsius | standard_name=toa_brightness_temperature units=celsius | btemp_threshold -110.15 56.85 -31.15
radiance_default | standard_name=toa_outgoing_radiance_per_unit_wavelength | crude 0 1
reflectance_default | standard_name=toa_bidirectional_reflectance | crude 0.0 100.0; gamma 2.0
surface_reflectance_default | standard_name=surface_bidirectional_reflectance | crude 0.0 100.0; gamma 2.0
day_night_mix | standard_name=day_night_mix | crude 0 1
temperature_difference | standard_name=temperature_difference | temperature_difference -10.0 10.0
tpw | name=TPW | crude -1.333 7.1666
mirs_tpw | name=TPW units=mm | crude -13.33 71.666
snow_cover | name=Snow reader=mirs | crude 0.0 1.0
sea_ice | name=SIce reader=mirs | crude 0.0 100.0
snow_water_equivalence | name=SWE reader=mirs | crude 0.0 20.0
cloud_liquid_water | name=CLW reader=mirs | crude 0.0 0.7
snow_fall_rate | name=SFR reader=mirs | crude 0.0 5.0
mirs_rain_rate | name=RR reader=mirs | colorize MIRS_RainRate 0 50
snow_grain_size | name=SnowGS | crude 0.3 0.7
btemp_23v | name=btemp_23v | crude 140 300.0
btemp_31v | name=btemp_31v | crude 140 300.0
btemp_50h | name=btemp_50h | crude 170 290.0
btemp_51h | name=btemp_51h | crude 170 290.0
btemp_52h | name=btemp_52h | crude 170 290.0
btemp_53h | name=btemp_53h | crude 200 270.0
btemp_54h1 | name=btemp_54h1 | crude 200 250.0
btemp_54h2 | name=btemp_54h2 | crude 210 230.0
btemp_55h | name=btemp_55h | crude 200 230.0
btemp_57h1 | name=btemp_57h1 | crude 200 230.0
btemp_57h2 | name=btemp_57h2 | crude 180 230.0
btemp_57h3 | name=btemp_57h3 | crude 180 250.0
btemp_57h4 | name=btemp_57h4 | crude 180 250.0
btemp_57h5 | name=btemp_57h5 | crude 180 280.0
btemp_57h6 | name=btemp_57h6 | crude 200 290.0
btemp_88v | name=btemp_88v | crude 150 300.0
btemp_165h | name=btemp_165h | crude 150 300.0
btemp_183h1_npp | name=btemp_183h1 platform_name=npp | crude 220 300.0
btemp_183h2_npp | name=btemp_183h2 platform_name=npp | crude 220 300.0
btemp_183h3 | name=btemp_183h3 | crude 220 280.0
btemp_183h4 | name=btemp_183h4 | crude 200 300.0
btemp_183h5 | name=btemp_183h5 | crude 220 265.0
btemp_50v | name=btemp_50v | crude 170 290.0
btemp_52v | name=btemp_52v | crude 170 290.0
btemp_54h | name=btemp_54h | crude 200 250.0
btemp_54v | name=btemp_54v | crude 210 230.0
btemp_89v1 | name=btemp_89v1 | crude 150 300.0
btemp_89v2 | name=btemp_89v2 | crude 150 300.0
btemp_157v | name=btemp_157v | crude 150 300.0
btemp_183h1 | name=btemp_183h1 | crude 220 265.0
btemp_183h2 | name=btemp_183h2 | crude 220 280.0
btemp_190v | name=btemp_190v | crude 200 300.0
clavrx_cloud_type | name=cloud_type reader=clavrx |
clavrx_cld_temp_acha | name=cld_temp_acha reader=clavrx | crude 160 320.0
clavrx_cld_height_acha | name=cld_height_acha reader=clavrx | crude 0 20000.0
clavrx_cloud_phase | name=cloud_phase reader=clavrx |
clavrx_cld_opd_dcomp | name=cld_opd_dcomp reader=clavrx | crude -0.2 160.0
clavrx_cld_opd_nlcomp | name=cld_opd_nlcomp reader=clavrx | crude -0.2 160.0
clavrx_cld_reff_dcomp | name=cld_reff_dcomp reader=clavrx | crude 0 160.0
clavrx_cld_reff_nlcomp | name=cld_reff_nlcomp reader=clavrx | crude 0 160.0
clavrx_cld_emiss_acha | name=cld_emiss_acha reader=clavrx | crude 0 1.0
clavrx_refl_lunar_dnb_nom | name=refl_lunar_dnb_nom reader=clavrx | crude -2.0 150.0
clavrx_rain_rate | name=rain_rate reader=clavrx | crude 0 32.0
sea_surface_temperature1 | standard_name=sea_surface_temperature | crude 267.317 309.816
sea_surface_temperature2 | standard_name=sea_surface_skin_temperature | crude 267.317 309.816
sea_surface_temperature3 | standard_name=sea_surface_sub-skin_temperature | crude 267.317 309.816
sea_surface_temperature4 | standard_name=sea_surface_subskin_temperature | crude 267.317 309.816
sea_surface_temperature_celsius | standard_name=sea_surface_subskin_temperature units=C | crude -5.8333 36.666
land_surface_temperature | sensor=modis standard_name=land_surface_temperature | crude 233.2 322.0
total_precipitable_water | standard_name=total_precipitable_water | crude -1.333 7.1666
total_precipitable_water_mm | units=mm standard_name=total_precipitable_water | crude -13.33 71.666
cloud_top_temperature_std | standard_name=cloud_top_temperature | crude 173.16 300.26
cloud_top_pressure | standard_name=cloud_top_pressure | crude 1.0 851.0
lifted_index | standard_name=lifted_index | crude 41.9562 -20.4018
cloud_optical_thickness | standard_name=cloud_optical_thickness | crude 0.0 12.75
depth | standard_name=depth | crude -1.33 7.17
ndvi | standard_name=ndvi | piecewise_linear -1.0,0.0,1.0 0.0,0.192156863,1.0
true_color_default | standard_name=true_color | crude -1.0 110.0; piecewise_linear 0,25,55,100,255 0,90,140,175,255 255
false_color_default | standard_name=false_color | crude -1.0 110.0; piecewise_linear 0,25,55,100,255 0,90,140,175,255 255
independent_crefl | standard_name=corrected_reflectance | crude -1.0 110.0; piecewise_linear 0,25,55,100,255 0,90,140,175,255 255
true_color_abi | sensor=abi standard_name=true_color | crude 0.0 100.0; piecewise_linear 0,25,55,100,255 0,90,140,175,255 255
channel_7_default | name=C07 | crude 400.15 164.15
channel_8_default | name=C08 | crude 280.0 180.0
channel_9_default | name=C09 | crude 280.0 180.0
channel_10_default | name=C10 | crude 280.0 180.0
cloud_top_height_abi | name=HT | colorize abi_l2_modified_cloud_top -300 20000
cloud_top_temperature_abi | name=TEMP | colorize abi_l2_modified_cloud_top 300 200
lst | name=LST sensor=abi | colorize rainbow 223.15 429.15
aod | name=AOD sensor=abi | colorize rainbow 0.0 1.0
fog_depth | name=Fog_Depth sensor=abi | colorize gridded_data 0.0 1000.0
ifr_prob | name=IFR_Fog_Prob sensor=abi | colorize IFR_PROB 0.0 100.0
lifr_prob | name=LIFR_Fog_Prob sensor=abi | colorize LIFR_PROB 0.0 100.0
mvfr_prob | name=MVFR_Fog_Prob sensor=abi | colorize MVFR_PROB 0.0 100.0
cloud_phase_l2 | name=Phase sensor=abi reader=abi_l2_nc | colorize cloud_phase_steps
cloud_top_pressure_l2 | name=PRES sensor=abi reader=abi_l2_nc | colorize abi_l2_modified_cloud_top 1000 100
true_color_agri | sensor=agri standard_name=true_color | crude 0.0 100.0; piecewise_linear 0,25,55,100,255 0,90,140,175,255 255
true_color_ahi | sensor=ahi standard_name=true_color | crude 0.0 100.0; piecewise_linear 0,25,55,100,255 0,90,140,175,255 255
channel_7_ahi | name=B07 | crude 400.15 164.15
channel_8_ahi | name=B08 | crude 280.0 180.0
channel_9_ahi | name=B09 | crude 280.0 180.0
channel_10_ahi | name=B10 | crude 280.0 180.0
true_color_ami | sensor=ami standard_name=true_color | crude 0.0 100.0; piecewise_linear 0,25,55,100,255 0,90,140,175,255 255
channel_7_ami | name=SW038 | crude 400.15 164.15
channel_8_ami | name=WV063 | crude 280.0 180.0
channel_9_ami | name=WV069 | crude 280.0 180.0
channel_10_ami | name=WV073 | crude 280.0 180.0
gaasp_clw | name=CLW sensor=amsr2 | crude 0.0 0.7
gaasp_sst | name=SST sensor=amsr2 | crude 267.317 309.816
gaasp_tpw | name=TPW sensor=amsr2 | colorize idl_rainbow 0 75
gaasp_wspd | name=WSPD sensor=amsr2 | auto; colorize idl_rainbow 0 1
gaasp_snow_cover | name=Snow_Cover sensor=amsr2 | colorize snow_cover_steps
gaasp_snow_depth | name=Snow_Depth sensor=amsr2 | colorize idl_rainbow 0 100
gaasp_swe | name=SWE sensor=amsr2 | colorize idl_rainbow 0 250
gaasp_soil_moisture | name=Soil_Moisture sensor=amsr2 | colorize idl_rainbow 0 1
gaasp_ice_concentration_nh | name=NASA_Team_2_Ice_Concentration_NH sensor=amsr2 | colorize idl_rainbow 0 100
gaasp_ice_concentration_sh | name=NASA_Team_2_Ice_Concentration_SH sensor=amsr2 | colorize idl_rainbow 0 100
gaasp_rain_rate | name=Rain_Rate sensor=amsr2 | colorize MIRS_RainRate 0 50
natural_color_crefl | standard_name=natural_color | crude -1.0 110.0; piecewise_linear 0,25,55,100,255 0,90,140,175,255 255
pre_enhanced_modis_crefl | sensor=modis standard_name=preenhanced_crefl |
reflectivity331 | name=Reflectivity331 sensor=omps | colorize rainbow 0.0 100.0
aerosol_index | name=AerosolIndex sensor=omps | colorize rainbow -2.0 5.0
column_amount_o3 | name=ColumnAmountO3 sensor=omps | colorize rainbow 100.0 600.0
normalized_dnb | sensor=viirs standard_name=equalized_radiance | crude 0.0 1.0
pre_enhanced_viirs_crefl | sensor=viirs standard_name=preenhanced_crefl |
viirs_confidence_cat | name=confidence_cat sensor=viirs | colorize ylorrd 7 9
viirs_confidence_pct | name=confidence_pct sensor=viirs | colorize ylorrd 0 100
viirs_fire_power | name=power sensor=viirs | colorize ylorrd 0 250
veg_index | standard_name=normalized_difference_vegetation_index sensor=viirs | colorize veg_index_steps
vlst | name=VLST sensor=viirs | colorize rainbow 223.15 429.15
aod550 | name=AOD550 sensor=viirs | colorize rainbow 0.0 1.0
cloud_top_height | name=CldTopHght | colorize abi_l2_modified_cloud_top -300 20000
cloud_base_height | name=CldBaseHght | colorize abi_l2_modified_cloud_top -300 20000
cloud_top_temperature | name=CldTopTemp | colorize abi_l2_modified_cloud_top 300 200
cloud_phase | name=CloudPhase sensor=viirs | colorize cloud_phase_steps
cloud_layer | name=CloudLayer sensor=viirs | cloud_layers; colorize cloud_layer_steps
total_cloud_fraction | name=Total_Cloud_Fraction sensor=viirs | colorize cloud_fraction_steps
nbr | sensor=viirs standard_name=normalized_burn_ratio | crude -1.0 1.0
iceage | name=IceAge sensor=viirs | colorize rainbow 1.0 8.0
icethickness | name=IceThickness sensor=viirs | colorize rainbow 0.0 3.0
iceconc | name=IceConc sensor=viirs | colorize rainbow 0.0 100.0
icesrftemp | name=IceSrfTemp sensor=viirs | colorize rainbow 230.0 275.0
"""

#: Platform aliases, of names in lower case without hyphens.
PLATFORMS = dict(
    x.split("=")
    for x in """suominpp=npp npp=npp snpp=npp n20=noaa20 n21=noaa21 n22=noaa22 n23=noaa23 noaa18=noaa18 noaa19=noaa19
noaa20=noaa20 noaa21=noaa21 noaa22=noaa22 noaa23=noaa23 jpss1=noaa20 jpss2=noaa21 jpss3=noaa22 jpss4=noaa23 j1=noaa20
j2=noaa21 j3=noaa22 j4=noaa23 fy3b=fy3b fy3c=fy3c fy3d=fy3d eosaqua=aqua eosterra=terra aqua=aqua terra=terra
gcomw1=gcom-w1 metopa=metopa metopb=metopb metopc=metopc""".split()
)

#: Keys that rules match, the name first.
MATCH_KEYS = ("name", "reader", "platform_name", "sensor", "standard_name", "units", "area_type")


def _pairs(text: str) -> dict[str, str]:
    return dict(x.split("=", 1) for x in text.split())


def resampling_rows() -> list[dict]:
    out = []
    for k, line in enumerate(RESAMPLING.strip().splitlines()):
        rule, keys, resampler, kwargs = (x.strip() for x in line.split("|"))
        args = _pairs(kwargs)
        out.append({"rule_id": rule, "kind": "resampling", "keys": _pairs(keys), "resampler": resampler or None, "default_target": args.pop("default_target", None), "kwargs": args, "load_order": k})
    return out


def enhancement_rows() -> list[dict]:
    out = []
    for k, line in enumerate(ENHANCEMENTS.strip().splitlines()):
        rule, keys, ops = (x.strip() for x in line.split("|"))
        out.append({"rule_id": rule, "kind": "enhancement", "keys": _pairs(keys), "operations": [x.strip() for x in ops.split(";") if x.strip()], "load_order": k})
    return out


#: Names of an operation's arguments, in the order of the table.
ARGUMENTS = {
    "crude": ("min_stretch", "max_stretch"),
    "btemp_threshold": ("min_in", "max_in", "threshold"),
    "gamma": ("gamma",),
    "piecewise_linear": ("xp", "fp", "reference_scale_factor"),
    "temperature_difference": ("min_stretch", "max_stretch"),
    "cloud_layers": (),
    "colorize": ("table", "lo", "hi"),
    "auto": (),
}


def operations(specs: list[str]) -> list[tuple[str, dict]]:
    """Operations of a rule as (method, arguments) for ``functions.enhance.apply_operations``."""
    out: list[tuple[str, dict]] = []
    for spec in specs:
        kind, *args = spec.split()
        values = [x if name == "table" else [float(y) for y in x.split(",")] if name in ("xp", "fp") else float(x) for name, x in zip(ARGUMENTS[kind], args, strict=False)]
        out.append((kind, dict(zip(ARGUMENTS[kind], values, strict=False))))
    return out
